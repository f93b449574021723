import random

import numpy as np
import pandas as pd
import pytest
from conftest import FOLDER
from pyspark.sql import functions as F

from cofre.llm import language_id
from cofre.llm.queries import held_out

SYLLABLES = {"aa": "ba na ra ta".split(), "bb": "ŝo ĝo klo fjo".split()}


def made(lang, words, seed):
    pick = random.Random(seed)
    return " ".join("".join(pick.choice(SYLLABLES[lang]) for _ in range(pick.randrange(1, 4))) for _ in range(words))


ROWS = [(i, made(lang, 60, i), lang) for i in range(60) for lang in [("aa", "bb")[i % 2]]]
MORE = [
    (100, made("aa", 40, 900), "bb"), (101, made("bb", 40, 901), None), (102, None, "aa"), (103, "", "aa"), (104, "12 34 !!", "bb"),
    (105, made("aa", 40_000, 902), None), (None, made("bb", 30, 903), None), (106, made("bb", 30, 904), "aa"), (106, made("bb", 30, 904), "aa"),
    (107, "ΩΨΧΦ ЖШЩ " * 30, None),
]


def test_languages_and_rejection(documents):
    df = documents(ROWS + MORE, clashing=True)
    found = language_id.identify(df, F.col("doc_id") < 60).collect()
    assert len(found) == len(ROWS + MORE)
    by_key = {r.key: r for r in found}
    assert all(by_key[k].lang_pred == lang and not by_key[k].rejected for k, _, lang in ROWS)
    assert [by_key[k].lang_pred for k in (100, 101, 102, 103, 104, 105, None, 106)] == ["aa", "bb", "und", "und", "und", "aa", "bb", "bb"]
    assert {k for k, r in by_key.items() if r.rejected} == {102, 103, 104, 107}
    assert all(0 <= r.score <= 1 for r in found)
    stay = language_id.drop_rejected(df, F.col("doc_id") < 60)
    assert stay.columns == df.columns
    assert stay.count() == len(found) - 4


def test_held_out_accuracy(spark):
    df = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet")
    found = language_id.identify(df, ~held_out(F.col("doc_id"))).join(df.select(F.col("doc_id").alias("key"), "lang"), "key")
    right = found.where("not learns").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98


def test_nothing_to_learn_from(documents):
    found = language_id.identify(documents([(1, "some text", None), (2, None, None)]), F.lit(True)).collect()
    assert [(r.lang_pred, r.score, r.rejected) for r in found] == [("und", 0.0, True)] * 2
    assert language_id.identify(documents([]), F.lit(True)).count() == 0


def plain_model(texts):
    """Interpolated Kneser-Ney as written in the textbooks, with dictionaries."""
    counts = {language_id.ORDER: {}}
    for text in texts:
        line = "  " + text
        for i in range(len(line) - 3):
            counts[4][line[i : i + 4]] = counts[4].get(line[i : i + 4], 0) + 1
    for size in (3, 2, 1):
        counts[size] = {}
        for gram in counts[size + 1]:
            counts[size][gram[1:]] = counts[size].get(gram[1:], 0) + 1

    def p(gram):
        size = len(gram)
        table = counts[size]
        of_context = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
        n1, n2 = (sum(n == k for n in table.values()) for k in (1, 2))
        discount = n1 / (n1 + 2 * n2) if n1 * n2 else 0.5
        if not of_context:
            return p(gram[1:])
        total = sum(of_context.values())
        rest = discount * len(of_context) / total
        lower = p(gram[1:]) if size > 1 else 1 / (len(of_context) + 1)
        return max(table.get(gram, 0) - discount, 0) / total * (gram in table) + rest * lower

    return p


@pytest.mark.parametrize("left_out", ["en", "de"])
def test_a_language_that_was_not_learned_is_rejected(spark, left_out):
    """95% of it go, and at most 1% of what was learned and held out."""
    df = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet")
    learns = ~held_out(F.col("doc_id")) & (F.col("lang") != left_out)
    found = language_id.identify(df, learns).join(df.select(F.col("doc_id").alias("key"), "lang"), "key").where("lang_pred <> 'und'")
    of = {(r["unknown"], r["learns"]): r["share"] for r in found.groupBy((F.col("lang") == left_out).alias("unknown"), "learns").agg(
        F.avg(F.col("rejected").cast("int")).alias("share")).collect()}
    assert of[True, False] >= 0.95
    assert of[False, False] <= 0.01 and of[False, True] <= 0.01


def test_a_large_model_is_joined(spark, documents, monkeypatch):
    df = documents(ROWS + MORE, clashing=True)
    few = {(r.key, r.row_hash): r for r in language_id.identify(df, F.col("doc_id") < 60).collect()}
    monkeypatch.setattr(language_id, "MODEL_ROWS", 0)
    joined = language_id.identify(df, F.col("doc_id") < 60).collect()
    assert len(joined) == len(ROWS + MORE)
    for r in joined:
        same = few[r.key, r.row_hash]
        assert (r.lang_pred, r.rejected) == (same.lang_pred, same.rejected)
        assert r.entropy is None and same.entropy is None or r.entropy == pytest.approx(same.entropy, rel=1e-4)


def test_hashes_are_as_wide_as_needed():
    packed = np.random.default_rng(1).integers(0, 1 << 62, 200_000)
    bits = language_id.hash_bits(len(packed))
    assert len(np.unique(language_id._hash(packed, bits))) == len(packed) and bits < 62


def test_probabilities_against_the_plain_formula(spark, documents):
    texts = ["abra kadabra", "barra abba rab", "da capo"]
    model = language_id.learn(documents([(i, t, "xx") for i, t in enumerate(texts)]))
    p = plain_model([f" {t} " for t in texts])
    for text in ("abra", "zebra dab", "caporab"):
        packed = language_id.grams(language_id.reduce_text(text))
        got = np.exp(model.log_probabilities("xx", packed))
        line = f"   {text} "
        assert got == pytest.approx([p(line[i : i + 4]) for i in range(len(line) - 3)], rel=1e-5)


def test_blocks_do_not_change_scores(monkeypatch):
    rows = [("aa", s, k, g, v) for s in (1, 2) for k, g, v in (("gram", 97, -1.0), ("gram", 98, -2.0), ("context", 0, -3.0))]
    model = language_id.Model(pd.DataFrame(rows, columns=["lang", "size", "kind", "gram", "value"]))
    texts = ["ab" * 50, None, "b", "a " * 30, "7"]
    whole = model.score(texts)
    monkeypatch.setattr(language_id, "BLOCK", 16)
    cut = model.score(texts)
    assert whole["n_scored"].tolist() == cut["n_scored"].tolist() == [101, 0, 2, 60, 0]
    assert np.allclose(np.stack(whole["total"]), np.stack(cut["total"]))
