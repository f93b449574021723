import hashlib
from collections import Counter

import pytest

from cofre.llm import mixing


def unit(*parts):
    digits = hashlib.md5("|".join(parts).encode()).hexdigest()[: mixing.DIGITS]
    return (int(digits, 16) + 0.5) / float(mixing.RANGE)


def plain(rows, weights=None, epochs=1.0, seed="mix-1"):
    """(doc_id, source, text) -> copies, one document at a time."""
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += max(len(text or ""), 1)
    share = {s: 1.0 if weights is None else weights.get(s, 0.0) for s in sizes}
    made = Counter()
    for key, text, source in rows:
        rate = epochs * share[source] / sum(share.values()) * sum(sizes.values()) / sizes[source] if sum(share.values()) else 0.0
        parts = max(-int(-rate // mixing.LARGEST_MEAN), 1)
        name = "-" if source is None else f"={source}"
        made[key, source, text] += mixing.poisson_count(rate, [unit(seed, "" if key is None else str(key), name, str(i)) for i in range(1, parts + 1)])
    return +made


ROWS = [(i, "abcde " * (i % 7), f"s{i % 3}") for i in range(300)] + [
    (1000, None, "rare"), (1001, "", "rare"), (None, "no key", "s1"), (1002, "no source", None), (1002, "no source", None),
    (1003, "long " * 20_000, "s2"),
]


@pytest.mark.parametrize(
    ("weights", "epochs"), [(None, 1.0), (None, 40.0), ({"s0": 3.0, "rare": 0.5, "elsewhere": 9.0}, 2.0), ({"s0": 0.0}, 1.0), ({None: 1.0}, 5.0)]
)
def test_copies(spark, documents, weights, epochs):
    df = documents([(k, t, "en", s) for k, t, s in ROWS], clashing=True)
    given = None if weights is None else spark.createDataFrame(list(weights.items()), "source string, weight double")
    mixed = mixing.mix_sources(df, given, epochs=epochs)
    assert mixed.columns == [*df.columns, "copy_no", "shuffle_key"]
    got = mixed.select("doc_id", "source", "text", "copy_no").collect()
    assert Counter((r.doc_id, r.source, r.text) for r in got) == plain(ROWS, weights, epochs)


def test_shares_and_order(documents):
    df = documents([(i, "x" * 50, "en", "big" if i % 10 else "small") for i in range(4000)])
    mixed = mixing.mix_sources(df).collect()
    share = sum(r.source == "small" for r in mixed) / len(mixed)
    assert abs(share - 0.5) < 0.04 and abs(len(mixed) - 4000) < 250
    keys = [r.shuffle_key for r in mixed]
    assert keys == sorted(keys)
    again = mixing.mix_sources(df.repartition(7)).collect()
    assert [r.doc_id for r in again] == [r.doc_id for r in mixed]


def test_columns_of_that_name_are_replaced(documents):
    df = documents([(1, "a", "en", "s")]).selectExpr("*", "'x' as copy_no", "'y' as `table`", "1 as parts")
    assert mixing.mix_sources(df, epochs=3.0).columns == ["doc_id", "text", "lang", "source", "n_chars", "table", "parts", "copy_no", "shuffle_key"]


def test_empty_table(documents):
    assert mixing.mix_sources(documents([])).count() == 0
