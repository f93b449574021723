"""Language identification with interpolated Kneser-Ney character models.

Training: every text with a language is reduced to its letters (lower case, runs of anything else are one space); tasks
count its 4-grams and combine them before the shuffle. From the summed counts Spark estimates one model per language:
4-grams by count, shorter ones by the number of distinct characters before them, each order interpolated with the
next. The counts grow with the corpus, the model with its distinct 4-grams.

A model is stored as sorted arrays of hashes with log probabilities and back-off weights, one pair per order and
language. The hashes are as wide as the counted grams need to meet hardly ever; where two do, the more probable one is kept. Up to
:data:`MODEL_ROWS` entries the arrays are broadcast; a larger model stays a table, with which the distinct grams of all texts are joined.

A text gets the language of lowest cross-entropy per character. It is rejected when that exceeds what is usual for the language by more than a
limit, which is calibrated on training texts that the model is not estimated from (every :data:`FOLD`-th, by hash, so that copies stay
together; of a language that has no others, they all teach and none calibrates):

* their excess under their own language, and
* the excess they would have if theirs were the language nobody has learned, under the best of the others.

The limit lies halfway between the high end of the first and the low end of the second, and for short texts higher by one standard error. Both are
measured anew for each corpus, so rejection doesn't fade as models grow. With a single language there is no second figure, and the limit is a
multiple of the first.

Defined results: a text that is null, empty or without letters is ``und`` with score 0 and is rejected. Ties go to the
language that sorts first. Training rows with null language or text teach nothing; with no training row at all every
text is ``und``. Without a text to calibrate on, only texts without letters are rejected. Texts of any length are scored whole, in
blocks. Repeated rows and null keys are scored like any other. An empty table gives no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofre.llm.common import Scratch, without

ORDER = 4
BLOCK = 1 << 20  # characters handled at once
#: Largest model that is broadcast, in entries of twelve bytes.
MODEL_ROWS = 4_000_000
#: One in so many training texts calibrates.
FOLD = 8
#: The high end of excess under the own language, and the low end under another one.
HIGH, LOW = 0.99, 0.05
#: The limit in high ends, if there is no other language.
ALONE = 3.0
UNKNOWN = "und"

_letter_table: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For each code point: folded to 16 bits when a letter, else a space."""
    if not _letter_table:
        points = np.arange(sys.maxunicode + 1, dtype=np.uint32)
        is_letter = np.fromiter((chr(p).isalpha() for p in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
        _letter_table.append(np.where(is_letter, np.maximum(points & 0xFFFF, 33), 32).astype(np.int64))
    return _letter_table[0]


def reduce_text(text: str | None) -> np.ndarray:
    """Letters of a text with single spaces between, before and after; empty when there is no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    reduced = np.concatenate([[32], _letters()[points], [32]])
    blank = reduced == 32
    reduced = reduced[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
    return reduced if len(reduced) > 1 else reduced[:0]


def grams(reduced: np.ndarray) -> np.ndarray:
    """Each character with the three before it, 16 bits each; spaces stand before the text."""
    padded = np.concatenate([np.full(ORDER - 2, 32, np.int64), reduced])
    n = len(padded) - ORDER + 1
    packed = np.zeros(max(n, 0), np.int64)
    for i in range(ORDER):
        packed = (packed << 16) | padded[i : i + n] if n > 0 else packed
    return packed


def _pieces(texts: Iterator[str | None]) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, grams) with at most BLOCK grams a piece."""
    for number, text in enumerate(texts):
        found = grams(reduce_text(text))
        for at in range(0, len(found), BLOCK):
            yield number, found[at : at + BLOCK]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for language, part in batch.groupby("lang", sort=False):
            block: list[np.ndarray] = []
            held = 0
            for _, piece in _pieces(part["text"]):
                block.append(piece)
                held += len(piece)
                if held >= BLOCK:
                    yield _counted(language, block)
                    block, held = [], 0
            if block:
                yield _counted(language, block)


def _counted(language: str, block: list[np.ndarray]) -> pd.DataFrame:
    found, n = np.unique(np.concatenate(block), return_counts=True)
    return pd.DataFrame({"lang": language, "gram": found, "n": n})


def count_grams(train: DataFrame, text: str, lang: str) -> DataFrame:
    """lang, gram, n over all rows with a language, and n_seen over those that don't calibrate."""
    rows = train.select(F.col(lang).alias("lang"), F.col(text).alias("text")).where("lang is not null and text is not null")
    # The language that reaches the workers has a mark before it: "=" for texts that calibrate, "-" for the others.
    marked = rows.select(F.concat(F.when(calibrates(F.xxhash64("text")), "=").otherwise("-"), F.col("lang")).alias("lang"), "text")
    counted = marked.mapInPandas(_count, "lang string, gram long, n long")
    seen = F.when(F.col("lang").startswith("-"), F.col("n")).otherwise(0)
    return counted.groupBy(F.substring("lang", 2, 1 << 30).alias("lang"), "gram").agg(F.sum("n").alias("n"), F.sum(seen).alias("n_seen"))


def calibrates(row_hash: Column) -> Column:
    """The text is one of those that calibrate."""
    return F.pmod(row_hash, F.lit(FOLD)) == 0


def estimate(counts: DataFrame, scratch: Scratch) -> DataFrame:
    """lang, size, kind (gram or context), gram, value: log probabilities and back-off weights of all orders."""
    orders = {ORDER: scratch.write(counts, f"counts-{ORDER}")}
    for size in range(ORDER - 1, 0, -1):
        mask = (1 << 16 * size) - 1
        longer = orders[size + 1].select("lang", F.col("gram").bitwiseAND(F.lit(mask)).alias("gram"))
        orders[size] = scratch.write(longer.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n")), f"counts-{size}")
    tables = []
    lower = None
    for size in range(1, ORDER + 1):
        rows = orders[size].withColumn("context", F.shiftrightunsigned("gram", 16))
        spectrum = rows.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("n1"), F.count_if(F.col("n") == 2).alias("n2"))
        discount = F.when(F.col("n1") * F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)
        spectrum = F.broadcast(spectrum.select("lang", discount.alias("discount")))  # a row per language
        contexts = rows.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("types"))
        contexts = contexts.join(spectrum, "lang")
        weight = F.col("discount") * F.col("types") / F.col("total")
        known = rows.join(contexts, ["lang", "context"])
        own = F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")
        if lower is None:
            known = known.withColumn("p", own + weight / (F.col("types") + 1))  # one share for any unseen character
        else:
            mask = (1 << 16 * (size - 1)) - 1
            suffix = known.withColumn("shorter", F.col("gram").bitwiseAND(F.lit(mask)))
            known = suffix.join(lower.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("q")), ["lang", "shorter"])
            known = known.withColumn("p", own + weight * F.col("q"))
        lower = scratch.write(known.select("lang", "gram", "p"), f"p-{size}")
        tables.append(lower.select("lang", F.lit(size).alias("size"), F.lit("gram").alias("kind"), "gram", F.log("p").alias("value")))
        if size > 1:
            share = F.log(weight)
        else:
            share = F.log(weight / (F.col("types") + 1))
        tables.append(contexts.select("lang", F.lit(size).alias("size"), F.lit("context").alias("kind"), F.col("context").alias("gram"), share.alias("value")))
    found = tables[0]
    for table in tables[1:]:
        found = found.unionByName(table)
    return scratch.write(found, "model")


def _hash(packed: np.ndarray, bits: int) -> np.ndarray:
    x = packed.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(64 - bits)).astype(np.int64)


def hash_bits(entries: int) -> int:
    """Width at which the hashes of so many grams meet with a probability below one in 500."""
    return min(62, 2 * max(entries, 2).bit_length() + 8)


class Model:
    """For each language and order: sorted hashes with values, of grams and of contexts."""

    def __init__(self, rows: pd.DataFrame, bits: int | None = None):
        self.languages = sorted(map(str, rows["lang"].unique()))
        places = rows.groupby(["lang", "size", "kind"], observed=True)
        self.bits = bits or hash_bits(int(places.size().max()) if len(rows) else 0)
        self.tables: dict[tuple[str, int, str], tuple[np.ndarray, np.ndarray]] = {}
        for place, part in places:
            hashes, values = _hash(part["gram"].to_numpy(), self.bits), part["value"].to_numpy(np.float64)
            order = np.lexsort((-values, hashes))
            hashes, values = hashes[order], values[order]
            first = np.concatenate([[True], hashes[1:] != hashes[:-1]])
            self.tables[place] = hashes[first], values[first].astype(np.float32)

    def _look_up(self, place: tuple[str, int, str], packed: np.ndarray) -> np.ndarray:
        """Values, NaN where there is none."""
        if place not in self.tables:
            return np.full(len(packed), np.nan, np.float32)
        hashes, values = self.tables[place]
        sought = _hash(packed, self.bits)
        at = np.minimum(np.searchsorted(hashes, sought), len(hashes) - 1)
        return np.where(hashes[at] == sought, values[at], np.float32(np.nan))

    def log_probabilities(self, language: str, packed: np.ndarray) -> np.ndarray:
        """log P(last character | those before it) of each packed gram."""
        found = np.zeros(len(packed))
        for size in range(1, ORDER + 1):
            gram = packed & ((1 << 16 * size) - 1) if size < ORDER else packed
            own = self._look_up((language, size, "gram"), gram)
            context = (gram.astype(np.uint64) >> np.uint64(16)).astype(np.int64)
            back = self._look_up((language, size, "context"), context)
            found = np.where(np.isnan(own), np.where(np.isnan(back), 0, back) + found, own)
        return found

    def score(self, texts: list[str | None]) -> pd.DataFrame:
        """n_scored of each text, and total: its log probability by language, in their order."""
        n_texts, n_languages = len(texts), len(self.languages)
        total = np.zeros((n_languages, n_texts))
        length = np.zeros(n_texts)
        block: list[tuple[int, np.ndarray]] = []
        held = 0

        def flush() -> None:
            codes, distinct = pd.factorize(np.concatenate([piece for _, piece in block]))
            owner = np.repeat([number for number, _ in block], [len(piece) for _, piece in block])
            length[:] += np.bincount(owner, minlength=n_texts)
            for i, language in enumerate(self.languages):
                logs = self.log_probabilities(language, distinct)
                total[i] += np.bincount(owner, weights=logs[codes], minlength=n_texts)

        for number, piece in _pieces(iter(texts)):
            block.append((number, piece))
            held += len(piece)
            if held >= BLOCK:
                flush()
                block, held = [], 0
        if block:
            flush()
        return pd.DataFrame({"total": list(total.T), "n_scored": length.astype(np.int64)})


def _totals(shared) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch.pop("text")
            yield pd.concat([batch.reset_index(drop=True), shared.value.score(list(texts))], axis=1)

    return run


def _text_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The distinct grams of every text that has a letter, with their number."""
    for batch in batches:
        for text_id, text in zip(batch["text_id"], batch["text"], strict=True):
            found, n = np.unique(grams(reduce_text(text)), return_counts=True)
            for at in range(0, len(found), BLOCK):
                yield pd.DataFrame({"text_id": text_id, "gram": found[at : at + BLOCK], "n": n[at : at + BLOCK]})


def _totals_by_join(rows: DataFrame, model: DataFrame, languages: list[str], scratch: Scratch, name: str) -> DataFrame:
    """The same totals from the model as a table: the distinct grams of all texts meet it order by order."""
    given = rows.withColumn("text_id", F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = given.select("text_id", "text").mapInPandas(_text_grams, "text_id string, gram long, n long")
    texts = scratch.write(texts.groupBy("text_id", "gram").agg(F.max("n").alias("n")), f"{name}-grams")
    logs = texts.select("gram").distinct().select("gram", F.explode(F.array(*map(F.lit, languages))).alias("lang"))
    logs = logs.withColumn("log", F.lit(0.0))
    value = F.col("value").cast("float").cast("double")
    for size in range(1, ORDER + 1):
        own, back = (
            model.where((F.col("size") == size) & (F.col("kind") == kind)).select("lang", F.col("gram").alias(kind), value.alias(f"{kind}_value"))
            for kind in ("gram", "context")
        )
        short = F.col("gram").bitwiseAND(F.lit((1 << 16 * size) - 1)) if size < ORDER else F.col("gram")
        logs = logs.withColumn("whole", F.col("gram")).withColumn("short", short).withColumn("context", F.shiftrightunsigned(short, 16))
        logs = logs.drop("gram").join(own.withColumnRenamed("gram", "short"), ["lang", "short"], "left").join(back, ["lang", "context"], "left")
        found = F.coalesce("gram_value", F.coalesce("context_value", F.lit(0.0)) + F.col("log"))
        logs = scratch.write(logs.select(F.col("whole").alias("gram"), "lang", found.alias("log")), f"{name}-logs{size}")
    of_text = texts.join(logs, "gram").groupBy("text_id", "lang").agg(F.sum(F.col("n") * F.col("log")).alias("total"), F.sum("n").alias("n_scored"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("lang", "total"))), lambda pair: pair["total"])
    of_text = of_text.groupBy("text_id").agg(in_order.alias("total"), F.max("n_scored").alias("n_scored"))
    none = F.array_repeat(F.lit(0.0), len(languages))
    return given.drop("text").join(of_text, "text_id", "left").select(
        *[c for c in rows.columns if c != "text"], F.coalesce("total", none).alias("total"), F.coalesce("n_scored", F.lit(0)).alias("n_scored")
    )


def learn(train: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """The model of all rows of ``train``, for use outside Spark."""
    counts = count_grams(train, text, lang)
    rows = estimate(counts.select("lang", "gram", "n"), Scratch(train.sparkSession, "language"))
    return Model(rows.toArrow().to_pandas(strings_to_categorical=True))


def _scored(rows: DataFrame, counts: DataFrame, scratch: Scratch, name: str) -> tuple[DataFrame, list[str]]:
    """``rows`` without their text, with total and n_scored by the model of ``counts``; and its languages."""
    spark = rows.sparkSession
    model = estimate(counts, Scratch(spark, "language"))
    languages = [r["lang"] for r in model.select("lang").distinct().orderBy("lang").collect()]
    if model.count() > MODEL_ROWS:
        return scratch.write(_totals_by_join(rows, model, languages, scratch, name), name), languages
    shared = spark.sparkContext.broadcast(Model(model.toArrow().to_pandas(strings_to_categorical=True)))
    kept = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    found = scratch.write(rows.mapInPandas(_totals(shared), f"{schema}, total array<double>, n_scored long"), name)
    shared.destroy()
    return found, languages


def _entropies(scored: DataFrame, languages: list[str]) -> DataFrame:
    """With entropy (nats per character) of every language, as an array of (entropy, lang) that sorts by both."""
    pairs = [F.struct((-F.get("total", F.lit(i)) / F.col("n_scored")).alias("entropy"), F.lit(x).alias("lang")) for i, x in enumerate(languages)]
    return scored.withColumn("entropies", F.when(F.col("n_scored") > 0, F.array(*pairs)))


def identify(
    df: DataFrame, learns: Column, text: str = "text", key: str = "doc_id", lang: str = "lang", high: float = HIGH, low: float = LOW
) -> DataFrame:
    """One row per row of ``df``: key, row_hash, learns, lang_pred, score, entropy, excess, rejected.

    ``learns`` tells the rows to learn from; languages are read from those alone.
    """
    scratch = Scratch(df.sparkSession, "languages")
    teaches = F.coalesce(learns, F.lit(False))
    rows = df.select(
        F.col(key).alias("key"), F.xxhash64(text).alias("row_hash"), teaches.alias("learns"),
        F.when(teaches, F.col(lang)).alias("taught"), F.col(text).alias("text"),
    )
    counts = scratch.write(count_grams(rows.where("learns"), "text", "taught"), "counts")
    # Languages, a few, of which every text would calibrate.
    unseen = [r["lang"] for r in counts.groupBy("lang").agg(F.sum("n_seen").alias("n")).where("n = 0").collect()]
    teaching = F.when(F.col("lang").isin(unseen), F.col("n")).otherwise(F.col("n_seen"))
    scored, languages = _scored(rows, counts.select("lang", "gram", teaching.alias("n")).where("n > 0"), scratch, "scored")
    fold = scored.where(F.col("taught").isNotNull() & ~F.col("taught").isin(unseen) & calibrates(F.col("row_hash")))
    usual, limit, unit = _calibrated(fold, languages, high, low)
    if not languages:
        none = F.lit(None).cast("double")
        return rows.select(
            "key", "row_hash", "learns", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), none.alias("entropy"),
            none.alias("excess"), F.lit(True).alias("rejected"),
        )
    judged = _entropies(scored, languages).withColumn("best", F.array_min("entropies"))
    most = F.array_max("total")
    score = 1 / F.aggregate("total", F.lit(0.0), lambda all_, x: all_ + F.exp(F.greatest(x - most, F.lit(-700.0))))
    entropy, known = F.col("best.entropy"), F.col("best").isNotNull()
    medians = F.create_map(*[F.lit(x) for pair in usual.items() for x in pair]) if usual else F.create_map().cast("map<string,double>")
    middle = F.coalesce(medians[F.col("best.lang")], F.lit(usual_of_all(usual)))
    excess = entropy - middle
    too_high = excess > F.lit(limit) + F.lit(unit) / F.sqrt(F.greatest("n_scored", F.lit(1)))
    return judged.select(
        "key", "row_hash", "learns", F.coalesce("best.lang", F.lit(UNKNOWN)).alias("lang_pred"), F.when(known, score).otherwise(0.0).alias("score"),
        entropy.alias("entropy"), excess.alias("excess"), F.coalesce(too_high, F.lit(True)).alias("rejected"),
    )


def usual_of_all(usual: dict[str, float]) -> float:
    """For a language without texts to calibrate on: the largest of the others' usual entropies."""
    return max(usual.values(), default=0.0)


def _calibrated(fold: DataFrame, languages: list[str], high: float, low: float) -> tuple[dict[str, float], float, float]:
    """Median entropy of each language, the limit of the excess, and the standard deviation of a character, over scored texts that the
    model has not seen."""
    if not languages:
        return {}, float("inf"), 0.0
    known = _entropies(fold, languages).where("n_scored > 0")
    own = F.filter("entropies", lambda x: x["lang"] == F.col("taught"))
    other = F.array_min(F.filter("entropies", lambda x: x["lang"] != F.col("taught")))
    both = known.select("taught", "n_scored", F.get(own, F.lit(0))["entropy"].alias("own"), other.alias("other")).where("own is not null")
    usual = {r["taught"]: r["m"] for r in both.groupBy("taught").agg(F.percentile_approx("own", 0.5, 10_000).alias("m")).collect()}
    if not usual:
        return {}, float("inf"), 0.0
    medians = F.create_map(*[F.lit(x) for pair in usual.items() for x in pair])
    own_excess = F.col("own") - medians[F.col("taught")]
    foreign = F.col("other.entropy") - F.coalesce(medians[F.col("other.lang")], F.lit(usual_of_all(usual)))
    found = both.agg(
        F.percentile_approx(own_excess, high, 10_000).alias("high"),
        F.percentile_approx(foreign, low, 10_000).alias("low"),
        F.percentile_approx(F.abs(own_excess) * F.sqrt("n_scored"), 0.5, 10_000).alias("deviation"),
    ).first()
    top, unit = max(found["high"], 0.0), found["deviation"] / 0.6745
    if found["low"] is None:
        return usual, ALONE * top, ALONE * unit
    return usual, (top + max(found["low"], top)) / 2, unit


def drop_rejected(df: DataFrame, learns: Column, text: str = "text", key: str = "doc_id", lang: str = "lang") -> DataFrame:
    """The rows of ``df`` that are not rejected, with all columns as they were; repeated rows all stay."""
    found = identify(df, learns, text, key, lang).where("rejected").select("key", "row_hash")
    gone = Scratch(df.sparkSession, "rejected").write(found.distinct(), "rows")
    return without(df, gone, key, F.xxhash64(df[text]))
