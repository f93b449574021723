from collections import defaultdict

import pytest

from cofre.llm import exact_dedup

EDGES = [
    (1, "Same Text"), (2, "same text"), (3, None), (4, ""), (5, "É"), (6, "é"), (7, "x" * 70_000), (8, "X" * 70_000),
    (9, "x" * 69_999 + "y"), (10, "twice"), (10, "twice"), (None, "no key"), (None, "NO KEY"), (11, "no key"), (12, " same text"),
]


def plain(rows):
    """Groups of rows by text with A-Z lower-cased: (best key, size)."""
    groups = defaultdict(list)
    for key, text in rows:
        groups["".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")].append(key)
    return {text: (max((k for k in keys if k is not None), default=None), len(keys)) for text, keys in groups.items()}


@pytest.mark.parametrize("settings", [{}, {"chunk_bytes": 700, "moduli": (5, 3)}])
def test_groups(documents, settings):
    # With tiny moduli many different texts share a fingerprint.
    rows = EDGES + [(100 + i, f"text {i % 40}") for i in range(120)]
    found = exact_dedup.exact_duplicates(documents(rows, clashing=True), **settings).collect()
    wanted = plain(rows)
    assert len(found) == len(rows)
    sizes = sorted((r.keep_id or -1, r.group_size) for r in found)
    assert sizes == sorted((wanted[t][0] or -1, wanted[t][1]) for t in (next(iter(plain([row]))) for row in rows))
    assert sum(r.kept for r in found) == len(wanted)
    assert all(r.key == r.keep_id for r in found if r.kept)


def test_chunks_combine():
    base, modulus = exact_dedup.BASES[0], exact_dedup.MODULI[0]
    whole, _ = exact_dedup.chunk_polynomial(b"abcdefgh", base, modulus)
    left, _ = exact_dedup.chunk_polynomial(b"abc", base, modulus)
    right, shift = exact_dedup.chunk_polynomial(b"defgh", base, modulus)
    assert (left * shift + right) % modulus == whole


def test_rows_stay_as_they_were(documents):
    rows = EDGES + [(20, "Same text")]
    df = documents(rows, clashing=True)
    stay = exact_dedup.drop_duplicates(df)
    assert stay.columns == df.columns
    assert sorted((r.doc_id or -1) for r in stay.select("doc_id").collect()) == sorted(k or -1 for k, _ in plain(rows).values())


def test_empty_table(documents):
    assert exact_dedup.exact_duplicates(documents([])).count() == 0
    assert exact_dedup.drop_duplicates(documents([])).count() == 0
