"""Toxicity by weak supervision.

1. Voters. A lexicon voter fires on a word, a pattern voter on words that begin alike, and a few fire on style (shouting,
   exclamation, masked letters). Which words and beginnings become voters is learned: for each, all labelled training
   texts are counted (copies under other keys once), and those that are found mostly in toxic texts are
   taken, beside a fixed list. A beginning that fires on the same texts as a longer one, or as a word, is left out. The
   ``most`` frequent have a vote of their own; all others share one, so none is lost.
2. Label model. Each voter fires with one probability on toxic and another on clean texts. Expectation-maximisation
   estimates both, the share of toxic texts, and how voters go together within a class; voters that repeat each other
   share their weight. The given label is one more voter, good but not infallible. Result: posterior labels.
3. A logistic regression on the votes is trained on the posterior labels and scores every text.

Counting covers all labelled training rows. Label model and regression are fitted on a hash sample of about half of
``fit_rows`` labelled rows of each class, or all if they are fewer, each with the weight of those it stands for, as votes, not texts. So
a class has rows in the sample whenever it has any. Voters, weights and that sample are all that reaches the driver.

Defined results: a null or empty text casts no vote and gets the score of such texts. Without labelled rows of both
classes the fixed list alone votes, with fixed weights. Of several labels for one key the highest counts; of voters that are equally
frequent the one that sorts first comes first. Texts of any length are read whole. Repeated
rows and null keys are scored like any other. An empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofre.llm.common import Scratch, join_few

VOTERS = 256
LEAST_TEXTS = 3
PRECISION = 0.5
FIT_ROWS = 20_000
#: Lengths of beginnings that can become patterns.
BEGINNINGS = (3, 4, 5, 6, 7, 8)

# Words that vote without having been learned.
LEXICON = (
    "asshole", "bastard", "bitch", "clown", "crap", "damn", "disgusting", "dumb", "fool", "freak", "fuck", "garbage",
    "hate", "idiot", "imbecile", "jerk", "kill", "loser", "moron", "pathetic", "pig", "scum", "shit", "stupid", "trash",
    "ugly", "vermin", "worthless",
    "basura", "cabron", "estupido", "estúpido", "idiota", "imbécil", "mierda", "asqueroso",
    "abruti", "connard", "crétin", "débile", "merde", "ordure", "salaud", "stupide",
    "abschaum", "arschloch", "blödmann", "dumm", "dummkopf", "scheisse", "scheiße", "trottel", "versager",
)
#: The vote that all learned words and beginnings without a vote of their own share.
POOLED = "learned:other"
STYLES = ("style:shouting", "style:exclaiming", "style:masked", "style:lexicon")

_WORD = re.compile(r"\w+")
_MASKED = re.compile(r"\b\w[*@#$]{2,}\w*")


def _style_votes(text: str, words: set[str]) -> list[str]:
    found = []
    n = max(len(text), 1)
    if len(text) >= 20 and sum(map(str.isupper, text)) > 0.6 * max(sum(map(str.isalpha, text)), 1):
        found.append(STYLES[0])
    if text.count("!") > 0.02 * n:
        found.append(STYLES[1])
    if _MASKED.search(text):
        found.append(STYLES[2])
    if not words.isdisjoint(_LEXICON_SET):
        found.append(STYLES[3])
    return found


_LEXICON_SET = frozenset(LEXICON)


def features(text: str | None) -> set[str]:
    """What may vote on a text: its words, their beginnings (with a star) and its style."""
    text = text or ""
    words = set(_WORD.findall(text.lower()))
    found = words | {w[:n] + "*" for w in words for n in BEGINNINGS if len(w) > n}
    return found.union(_style_votes(text, words))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for at in range(0, len(batch), 2000):
            part = batch.iloc[at : at + 2000]
            counts = {0: Counter(), 1: Counter()}
            for text, toxic in zip(part["text"], part["toxic"], strict=True):
                counts[int(toxic)].update(features(text))
            for toxic, found in counts.items():
                if not found:  # an empty frame has no text column
                    continue
                yield pd.DataFrame({"feature": list(found), "n_toxic": [n * toxic for n in found.values()], "n_clean": [n * (1 - toxic) for n in found.values()]})


def choose_voters(labelled: DataFrame, scratch: Scratch, least_texts: int = LEAST_TEXTS, precision: float = PRECISION) -> list[str]:
    """The learned words and beginnings, the most frequent first. ``labelled``: text, toxic."""
    counted = labelled.select("text", "toxic").mapInPandas(_count, "feature string, n_toxic long, n_clean long")
    totals = counted.groupBy("feature").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))
    share = F.col("n_toxic") / (F.col("n_toxic") + F.col("n_clean"))
    good = totals.where((F.col("n_toxic") >= least_texts) & (share >= precision) & ~F.col("feature").startswith("style:"))
    good = scratch.write(good.select("feature", "n_toxic", "n_clean", (F.col("n_toxic") * share * share).alias("weight")), "good")
    # Whatever has a longer word or beginning, has the shorter one: with equal counts they fire on the same texts.
    bare = F.rtrim(F.col("feature"), F.lit("*"))
    shorter = F.array(*[F.when(F.length(bare) > n, F.concat(F.substring(bare, 1, n), F.lit("*"))) for n in BEGINNINGS])
    same = good.select(F.explode(F.array_compact(shorter)).alias("feature"), "n_toxic", "n_clean").distinct()
    chosen = good.join(same, ["feature", "n_toxic", "n_clean"], "left_anti").orderBy(F.desc("weight"), "feature").select("feature")
    names = [row["feature"] for row in chosen.collect()]
    scratch.drop("good")
    return names


@dataclass
class LabelModel:
    """P(vote | toxic), P(vote | clean), share of toxic texts, weight of each voter, and the same for the given label."""

    toxic: np.ndarray
    clean: np.ndarray
    share: float
    weight: np.ndarray
    label: tuple[float, float]

    @classmethod
    def fit(cls, votes: np.ndarray, labels: np.ndarray, of: np.ndarray | None = None, rounds: int = 10) -> LabelModel:
        """``of``: how many texts each row stands for."""
        of = np.ones(len(labels)) if of is None else of
        posterior = np.where(labels == 1, 0.97, 0.02)
        model = None
        for _ in range(rounds):
            is_toxic, is_clean = of * posterior, of * (1 - posterior)
            n_toxic, n_clean = is_toxic.sum(), is_clean.sum()
            toxic = (is_toxic @ votes + 0.5) / (n_toxic + 1)
            clean = (is_clean @ votes + 0.05) / (n_clean + 1)
            excess = np.zeros((votes.shape[1],) * 2)
            for rate, given, n in ((toxic, is_toxic, n_toxic), (clean, is_clean, n_clean)):
                together = (votes * given[:, None]).T @ votes / max(n, 1e-9) - np.outer(rate, rate)
                spread = np.sqrt(np.outer(rate * (1 - rate), rate * (1 - rate))) + 1e-6
                excess = np.maximum(excess, together / spread)
            np.fill_diagonal(excess, 0)
            weight = 1 / (1 + np.maximum(excess - 0.1, 0).sum(axis=0))
            label = (
                float(np.clip((is_toxic @ labels) / max(n_toxic, 1e-9), 0.9, 0.99)),
                float(np.clip((is_clean @ labels) / max(n_clean, 1e-9), 0.002, 0.05)),
            )
            model = cls(toxic, clean, float(np.clip(n_toxic / of.sum(), 1e-4, 0.5)), weight, label)
            posterior = model.posterior(votes, labels)
        return model

    def posterior(self, votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        fires = self.weight * np.log(self.toxic / self.clean)
        silent = self.weight * np.log((1 - self.toxic) / (1 - self.clean))
        odds = np.log(self.share / (1 - self.share)) + silent.sum() + votes @ (fires - silent)
        odds += np.where(labels == 1, np.log(self.label[0] / self.label[1]), np.log((1 - self.label[0]) / (1 - self.label[1])))
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit_linear(votes: np.ndarray, targets: np.ndarray, of: np.ndarray | None = None, penalty: float = 1.0, rounds: int = 12) -> np.ndarray:
    """Weights of a logistic regression on soft targets, by Newton's method; the last is the constant. ``of``: as in the label model."""
    of = np.ones(len(targets)) if of is None else of / of.mean()
    inputs = np.hstack([votes, np.ones((len(votes), 1))])
    ridge = np.full(inputs.shape[1], penalty)
    ridge[-1] = 1e-6
    weights = np.zeros(inputs.shape[1])
    for _ in range(rounds):
        guess = 1 / (1 + np.exp(-np.clip(inputs @ weights, -30, 30)))
        gradient = inputs.T @ (of * (guess - targets)) + ridge * weights
        curvature = (inputs * (of * guess * (1 - guess))[:, None]).T @ inputs + np.diag(ridge)
        step = np.linalg.solve(curvature, gradient)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _votes(names: dict[str, int]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.pop("text")
            yield batch.assign(votes=[sorted({names[f] for f in features(t) if f in names}) for t in texts])

    return run


def _dense(votes: list, size: int) -> np.ndarray:
    found = np.zeros((len(votes), size))
    for i, cast in enumerate(votes):
        found[i, np.asarray(cast, int)] = 1
    return found


def score_texts(
    df: DataFrame, labels: DataFrame, learns: Column, text: str = "text", key: str = "doc_id", label: str = "toxic",
    most: int = VOTERS, fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per row of ``df``: key, row_hash, learns, score, votes (the names of the voters that fired).

    ``learns`` tells the rows whose labels are learned from; no other label is read.
    """
    scratch = Scratch(df.sparkSession, "toxicity")
    teaches = F.coalesce(learns, F.lit(False))
    given = labels.select(F.col(key).alias("l_key"), F.col(label).cast("int").alias("toxic")).where("toxic in (0, 1)")
    given = given.groupBy("l_key").agg(F.max("toxic").alias("toxic"))
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"), teaches.alias("learns"), F.xxhash64(text).alias("row_hash"))
    # Which rows to learn from is settled on keys and hashes; of equal texts with one label the smallest key is taken.
    keyed = rows.where("learns").select("key", "row_hash").join(given, F.col("key") == F.col("l_key"))
    chosen = keyed.groupBy(F.col("row_hash").alias("c_hash"), "toxic").agg(F.min("key").alias("c_key"))
    chosen = scratch.write(chosen, "chosen")
    teaching = rows.where("learns")
    labelled = join_few(teaching, chosen, [(F.col("key"), "c_key"), (F.col("row_hash"), "c_hash")]).select("row_hash", "text", "toxic")
    labelled = scratch.write(labelled, "labelled")
    learned = choose_voters(labelled, scratch)
    names = list(dict.fromkeys([*learned[:most], *LEXICON, *STYLES, POOLED]))
    index = {name: i for i, name in enumerate(names)}
    index |= {name: index[POOLED] for name in learned[most:] if name not in index}
    n_of = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {toxic: min(1.0, fit_rows / 2 / n) for toxic, n in n_of.items()}
    limit = F.when(F.col("toxic") == 1, int(1_000_000 * share.get(1, 1.0))).otherwise(int(1_000_000 * share.get(0, 1.0)))
    drawn = labelled.where(F.pmod(F.xxhash64("row_hash"), F.lit(1_000_000)) < limit)
    sample = drawn.mapInPandas(_votes(index), "row_hash long, toxic int, votes array<int>").toPandas()
    scratch.drop("labelled")
    if len(n_of) == 2:
        votes, gold = _dense(list(sample["votes"]), len(names)), sample["toxic"].to_numpy()
        of = 1 / np.where(gold == 1, share[1], share[0])
        posterior = LabelModel.fit(votes, gold, of).posterior(votes, gold)
        weights = fit_linear(votes, posterior, of)
    else:
        weights = np.array([2.0 if name in _LEXICON_SET else 0.0 for name in names] + [-3.0])
    names_of, weights_of = list(names), weights

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _votes(index)(batches):
            cast = list(batch.pop("votes"))
            odds = [weights_of[v].sum() + weights_of[-1] for v in (np.asarray(c, int) for c in cast)]
            scores = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
            yield batch.assign(score=scores, votes=[[names_of[i] for i in c] for c in cast])

    kind = df.schema[key].dataType.simpleString()
    return rows.mapInPandas(score, f"key {kind}, learns boolean, row_hash long, score double, votes array<string>")
