"""Mixing sources to target weights by Poisson replication.

A document of source s is repeated k times, k drawn from a Poisson distribution whose mean is the source's target
rate: ``weight(s) * total size / size(s)``, times an overall factor. The draw inverts the distribution at a number
between 0 and 1 that a hash of seed, document and source gives, so a document's count does not depend on order,
partitioning or reruns. Copies are then shuffled globally by another hash.

Weights are a small table, and so is the count per source; both join by shuffle unless counted and small. A source
that holds a third of all rows is counted with a combine before the shuffle, and the copies' order is a hash, which
spreads any source over all tasks.

Defined results: a null source is a source of its own. Sources without a weight get none of the mix (weight 0); with
no weights given, all sources get the same. A null or empty text counts as one unit, so no source has size 0. Rows
repeated with the same key get the same count. Columns of the input named like the added ones are replaced.
"""

from __future__ import annotations

from math import exp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofre.llm.common import bounded, free_name

#: Digits of the hash that make the number between 0 and 1, and their range.
DIGITS = 13
RANGE = 16**DIGITS
#: A mean is split into parts of at most this size: a sum of Poisson numbers is Poisson, and exp(-mean) stays exact.
LARGEST_MEAN = 16.0
#: Most that one part draws: beyond it the distribution at mean 16 has less weight than the hash can resolve.
MOST = 80


def unit_hash(*parts: Column) -> Column:
    """A number in (0, 1), from the MD5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(RANGE))


def poisson_table(mean: Column) -> Column:
    """P(K <= 0), P(K <= 1), ... as an array."""
    first = F.exp(-mean)

    def step(state: Column, k: Column) -> Column:
        term = state["term"] * mean / k
        total = state["total"] + term
        return F.struct(term.alias("term"), total.alias("total"), F.concat(state["all"], F.array(total)).alias("all"))

    start = F.struct(first.alias("term"), first.alias("total"), F.array(first).alias("all"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(MOST)), start, step, lambda state: state["all"])


def rates(df: DataFrame, weights: DataFrame | None, source: str, size: Column, epochs: float) -> DataFrame:
    """_source, rate, parts, table: a row for each source that occurs."""
    sizes = df.groupBy(F.col(source).alias("_source")).agg(F.sum(size).alias("n"))
    if weights is None:
        shares = sizes.withColumn("weight", F.lit(1.0))
    else:
        given = weights.select(F.col("source").alias("_given"), F.col("weight").cast("double").alias("weight"))
        shares = sizes.join(given, F.col("_source").eqNullSafe(F.col("_given")), "left").withColumn(
            "weight", F.coalesce("weight", F.lit(0.0))
        )
    totals = shares.agg(F.sum("n").alias("all_n"), F.sum("weight").alias("all_weight"))
    rate = F.when(
        F.col("all_weight") > 0,
        F.lit(float(epochs)) * F.col("weight") / F.col("all_weight") * F.col("all_n").cast("double") / F.col("n").cast("double"),
    ).otherwise(0.0)
    parts = F.greatest(F.ceil(F.col("rate") / LARGEST_MEAN), F.lit(1)).cast("int")
    return (
        shares.join(F.broadcast(totals))  # one row
        .select("_source", rate.alias("rate"))
        .withColumn("parts", parts)
        .withColumn("table", poisson_table(F.col("rate") / F.col("parts")))
    )


def mix_sources(
    df: DataFrame,
    weights: DataFrame | None = None,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
    epochs: float = 1.0,
    seed: str = "mix-1",
) -> DataFrame:
    """All columns of ``df``, copy_no (0, 1, ...) and shuffle_key, in shuffled order: dealt to partitions by ``shuffle_key`` and sorted by it there. Sizes count code points."""
    names = [c for c in df.columns if c not in ("copy_no", "shuffle_key")]
    size = F.greatest(F.length(F.coalesce(F.col(text), F.lit(""))), F.lit(1)).cast("long")
    rated = rates(df, weights, source, size, epochs)
    drawing, count = free_name(df, "_drawing"), free_name(df, "_count")
    rated = rated.select(F.struct("_source", "parts", "table").alias(drawing))
    name = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-"))
    same = F.concat_ws("|", F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")), name)
    joined = df.join(bounded(rated), df[source].eqNullSafe(F.col(drawing)["_source"]))

    def draw(part: Column) -> Column:
        u = unit_hash(same, part.cast("string"))
        return F.size(F.filter(F.col(drawing)["table"], lambda total: total < u))

    drawn = F.aggregate(F.transform(F.sequence(F.lit(1), F.col(drawing)["parts"]), draw), F.lit(0), lambda a, b: a + b)
    counted = joined.select(*[df[c] for c in names], drawn.alias(count)).where(F.col(count) > 0)
    copies = counted.select(*names, F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias("copy_no"))
    shuffled = copies.withColumn("shuffle_key", F.xxhash64(same, F.col("copy_no")))
    # Dealt by a hash and sorted by another one: as good a shuffle as one sort, without a pass that looks for the ranges.
    return shuffled.repartition("shuffle_key").sortWithinPartitions("shuffle_key", key, "copy_no")


def poisson_count(mean: float, u: list[float]) -> int:
    """The same count in plain Python, for checks: one number for each part of the mean."""
    drawn = 0
    for x in u:
        term = total = exp(-mean / len(u))
        k = 0
        while total < x and k < MOST:
            k += 1
            term = term * (mean / len(u)) / k
            total += term
        drawn += k if total >= x else MOST + 1
    return drawn
