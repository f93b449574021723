import math
import random
import re

import numpy as np
import pytest
from conftest import FOLDER

from cofre.llm import near_duplicates
from cofre.llm.common import Scratch
from cofre.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")

CUTOFFS = np.array(near_duplicates.cutoffs())


def shingles(text, size):
    words = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    size = min(size, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if words else frozenset()


def brute(rows, size, threshold=80):
    """key -> (set size, component), comparing all pairs."""
    sets = {key: shingles(text, size) for key, text in rows}
    of = {key: key for key in sets}

    def find(key):
        while of[key] != key:
            key = of[key]
        return key

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            common, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if union and sets[a] and sets[b] and common * 100 >= union * threshold:
                one, other = sorted((find(a), find(b)))
                of[other] = one
    return {key: (len(sets[key]), find(key)) for key in keys}


@pytest.mark.parametrize("size", [2, 5])
def test_whole_table_against_all_pairs(spark, size):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {r.key: (r.n_shingles, r.component_id) for r in near_duplicates.near_duplicates(df, words=size).collect()}
    assert found == brute([(r.doc_id, r.text) for r in df.collect()], size)


def variants(count, length, changes, seed):
    """Copies of one text, each with some words replaced: some pairs are similar, some are not."""
    pick = random.Random(seed)
    base = [f"w{pick.randrange(5000)}" for _ in range(length)]
    made = []
    for _ in range(count):
        copy = list(base)
        for _ in range(pick.randrange(changes)):
            copy[pick.randrange(length)] = f"w{pick.randrange(5000)}"
        made.append(" ".join(copy))
    return made


def test_one_large_group_and_edges(documents):
    texts = variants(150, 60, 14, 1) + variants(40, 9, 4, 2)
    rows = list(enumerate(texts)) + [
        (1000, None), (1001, ""), (1002, " \t\n"), (1003, "one"), (1004, "ONE"), (1005, "One two"), (1006, "b " * 50_000),
        (1007, "b " * 40_000), (1008, " "), (1009, "é É"),
    ]
    found = near_duplicates.near_duplicates(documents(rows, clashing=True), words=2).collect()
    assert {r.key: (r.n_shingles, r.component_id) for r in found} == brute(rows, 2)
    assert all(r.kept == (r.key == r.component_id) for r in found)


def test_repeated_rows_and_null_keys(documents):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (7, "other words here"), (None, "x y z"), (None, None), (None, None)]
    df = documents(rows, clashing=True)
    found = near_duplicates.near_duplicates(df, words=2).collect()
    assert len(found) == len(rows)
    assert sum(r.kept for r in found) == 5
    stay = near_duplicates.drop_near_duplicates(df, words=2)
    assert stay.columns == df.columns
    # Texts without words all stay, also rows that can't be told apart.
    assert sorted((r.doc_id or -1, r.text or "") for r in stay.collect()) == [(-1, ""), (-1, ""), (-1, "x y z"), (5, "a b c d"), (7, "other words here")]


def test_empty_table(documents):
    assert near_duplicates.near_duplicates(documents([])).count() == 0
    assert near_duplicates.drop_near_duplicates(documents([])).count() == 0


def test_words_do_not_depend_on_segments(monkeypatch):
    text = "Über einen   langen " + "x" * 100 + "\ttext " * 40 + "y" * 50
    whole = near_duplicates.word_hashes(text)
    assert len(whole) == len(WORDS.findall(text))
    monkeypatch.setattr(near_duplicates, "SEGMENT", 64)
    cut = near_duplicates.word_hashes(text)
    longer = [len(w.encode()) > 64 for w in WORDS.findall(text)]  # hashed in another way
    assert [a == b for a, b in zip(whole, cut, strict=True)] == [not x for x in longer]


def test_cutoffs_keep_similar_pairs():
    for seen, most in zip(range(64, 257, 64), near_duplicates.cutoffs(80, 1e-9), strict=True):
        lost = sum(math.comb(seen, k) * 0.1**k * 0.9 ** (seen - k) for k in range(most + 1, seen + 1))
        assert lost < 1e-6
        assert most < 0.45 * seen


def test_parity_bounds_the_difference():
    pick = np.random.default_rng(4)
    a = np.unique(pick.integers(0, 1 << 63, 400).astype(np.uint64))
    b = np.unique(np.concatenate([a[:350], pick.integers(0, 1 << 63, 30).astype(np.uint64)]))
    apart = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in near_duplicates.parity(a) ^ near_duplicates.parity(b))
    assert 40 < apart <= 80


def test_signature_estimates_similarity():
    pick = np.random.default_rng(3)
    a = np.unique(pick.integers(0, 1 << 63, 1000).astype(np.uint64))
    b = np.unique(np.concatenate([a[:700], pick.integers(0, 1 << 63, 300).astype(np.uint64)]))
    same = 256 - sum(bin(int(x) & (1 << 64) - 1).count("1") for x in near_duplicates.signature(a)[1] ^ near_duplicates.signature(b)[1])
    assert abs(same / 256 - (1 + 700 / 1300) / 2) < 0.12


@pytest.mark.parametrize(("one", "two"), [(4, 5), (8, 10), (80, 100)])
def test_signatures_keep_small_similar_pairs(one, two):
    pick = np.random.default_rng(5)
    lost = 0
    for _ in range(8_000):
        b = pick.integers(0, 1 << 63, two).astype(np.uint64)
        apart = near_duplicates.signature(b[:one])[1] ^ near_duplicates.signature(b)[1]
        differ = np.cumsum([bin(int(x) & (1 << 64) - 1).count("1") for x in apart])
        lost += any(differ > CUTOFFS)
    assert lost == 0


def test_short_texts_with_four_of_five_shingles(documents):
    texts = [[f"w{i}x{j}" for j in range(6)] for i in range(1500)]
    rows = [(2 * i + k, " ".join(words[: 5 + k])) for i, words in enumerate(texts) for k in (0, 1)]
    found = near_duplicates.near_duplicates(documents(rows), words=2).collect()
    assert {r.key: r.component_id for r in found} == {key: key - key % 2 for key, _ in rows}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(200)] + [(500, 501)], "a long, b long")
    found = {r.node: r.component for r in components(links, Scratch(spark, "test"), "chain").collect()}
    assert found == {i: 0 for i in range(1, 201)} | {501: 500}
