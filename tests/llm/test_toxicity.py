import random

import numpy as np
from conftest import FOLDER
from pyspark.sql import functions as F

from cofre.llm import toxicity
from cofre.llm.common import Scratch
from cofre.llm.queries import held_out

CLEAN = [f"word{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12)]


def rows(n, seed):
    pick, made = random.Random(seed), []
    for i in range(n):
        words = [pick.choice(CLEAN) for _ in range(40)]
        toxic = i % 8 == 0
        if toxic:
            words[3] = pick.choice(["blarg", "zonker", f"grum{chr(97 + i % 20)}fil"])
        made.append((i, " ".join(words), int(toxic)))
    return made


def test_learned_voters_catch_what_was_held_out(spark, documents):
    made = rows(480, 1)
    edges = [(1000, None), (1001, ""), (1002, "you idiot"), (None, "blarg blarg"), (1003, "worda" + " wordb" * 20_000), (2, made[2][1])]
    df = documents([(k, t) for k, t, _ in made] + edges, clashing=True)
    labels = spark.createDataFrame([(k, 0, t, "x") for k, _, t in made] + [(3, 0, 0, "x"), (5, 0, None, "x"), (None, 0, 1, "x")], "doc_id long, quality int, toxic int, score string")
    found = toxicity.score_texts(df, labels, F.col("doc_id") % 4 != 2).collect()
    assert len(found) == len(made) + len(edges)
    score = {r.key: r.score for r in found}
    assert all((score[k] >= 0.3) == bool(t) for k, _, t in made)
    assert score[None] >= 0.3
    assert score[1000] == score[1001] < 0.3 and score[1003] < 0.3
    assert all(0 <= r.score <= 1 for r in found)
    hidden = spark.createDataFrame([(k, 0, 1 - t if k % 4 == 2 else t, "x") for k, _, t in made], labels.schema)
    again = {r.key: r.score for r in toxicity.score_texts(df, hidden, F.col("doc_id") % 4 != 2).collect()}
    assert all(again[k] == score[k] for k, _, _ in made)  # labels that are held out are not read


def test_without_labels(spark, documents):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = {r.key: r.score for r in toxicity.score_texts(documents([(1, "you idiot, moron"), (2, "fine words")]), labels, F.lit(True)).collect()}
    assert found[1] >= 0.3 > found[2]
    assert toxicity.score_texts(documents([]), labels, F.lit(True)).count() == 0


def test_held_out_accuracy(spark):
    folder = FOLDER.replace("0.001", "0.1")
    df, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.score_texts(df, labels, ~held_out(F.col("doc_id"))).where("not learns").withColumnRenamed("key", "doc_id")
    counts = found.join(labels, "doc_id").groupBy("toxic", (F.col("score") >= 0.3).alias("flag")).count().collect()
    n = {(r.toxic, r.flag): r["count"] for r in counts}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.85
    assert n.get((0, True), 0) / (n[0, False] + n.get((0, True), 0)) < 0.02


def plain_choice(labelled):
    """Counts and choice once more, with sets of texts."""
    texts_of = {}
    for text, toxic in set(labelled):
        for feature in toxicity.features(text):
            if not feature.startswith("style:"):
                texts_of.setdefault(feature, set()).add((text, toxic))
    good = {}
    for feature, texts in texts_of.items():
        n = sum(t for _, t in texts)
        if n >= toxicity.LEAST_TEXTS and n >= toxicity.PRECISION * len(texts):
            good[feature] = (n * (n / len(texts)) ** 2, texts)
    kept = [
        f for f, (_, texts) in good.items()
        if not (f.endswith("*") and any(g != f and len(g.rstrip("*")) > len(f) - 1 and g.startswith(f[:-1]) and good[g][1] == texts for g in good))
    ]
    return sorted(kept, key=lambda f: (-good[f][0], f))


def test_choice_of_voters_against_sets_of_texts(spark):
    made = [(text, toxic) for _, text, toxic in rows(400, 7)]
    labelled = spark.createDataFrame(made, "text string, toxic int").distinct()
    got = toxicity.choose_voters(labelled, Scratch(spark, "test"))
    wanted = plain_choice(made)
    assert sorted(got) == sorted(wanted) and got[:3] == wanted[:3]
    assert "blarg" in got and "bla*" not in got


def test_voters_beyond_the_named_ones_share_a_vote(spark, documents):
    made = rows(480, 1)
    labels = spark.createDataFrame([(k, 0, t) for k, _, t in made], "doc_id long, quality int, toxic int")
    found = toxicity.score_texts(documents([(k, t) for k, t, _ in made]), labels, F.col("doc_id") % 4 != 2, most=2).collect()
    assert any(toxicity.POOLED in r.votes for r in found)
    score = {r.key: r.score for r in found}
    assert all((score[k] >= 0.3) == bool(t) for k, _, t in made)


def test_a_rare_class_is_in_the_sample(spark, monkeypatch):
    """One toxic row in 50,000 is fitted on, so the fixed weights don't take over."""
    given = spark.range(50_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("clean text "), F.col("id").cast("string")).alias("text"))
    given = given.where("doc_id <> 777").unionByName(spark.sql("select 777L as doc_id, 'you stupid idiot' as text"))
    labels = given.select("doc_id", F.lit(0).alias("quality"), (F.col("doc_id") == 777).cast("int").alias("toxic"))
    seen = []
    plain = toxicity.LabelModel.fit.__func__
    monkeypatch.setattr(toxicity.LabelModel, "fit", classmethod(lambda cls, votes, gold, of: seen.append((gold.sum(), len(gold), of.sum())) or plain(cls, votes, gold, of)))
    toxicity.score_texts(given, labels, F.lit(True), fit_rows=2000)
    assert len(seen) == 1 and seen[0][0] == 1 and 500 < seen[0][1] < 2000 and abs(seen[0][2] - 50_000) < 8000


def test_label_model_recovers_accuracies():
    pick = np.random.default_rng(5)
    truth = pick.random(6000) < 0.2
    rates = [(0.9, 0.02), (0.7, 0.05), (0.5, 0.01)]
    votes = np.stack([np.where(truth, pick.random(6000) < a, pick.random(6000) < b) for a, b in rates] , axis=1).astype(float)
    votes = np.hstack([votes, votes[:, :1]])  # one voter repeats another
    labels = np.where(pick.random(6000) < 0.03, ~truth, truth).astype(int)
    model = toxicity.LabelModel.fit(votes, labels)
    assert np.allclose(model.toxic[:3], [a for a, _ in rates], atol=0.06)
    assert np.allclose(model.clean[:3], [b for _, b in rates], atol=0.03)
    assert model.weight[0] == model.weight[3] < 0.7 < model.weight[2]
    posterior = model.posterior(votes, labels)
    assert ((posterior > 0.5) == truth).mean() > 0.97
