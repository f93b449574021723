"""Contiguous surrogate keys, next ids and appends that skip known keys."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cofre.operators.keysets import kept

# log2 of the consecutive integers per numbering bucket. Keys are unique integers, so a bucket can
# never hold more rows than that, however the keys are spread.
BUCKET_BITS = 21
# Buckets with less than this share of their integers taken, on average, are not worth having.
FILLED = 1 / 16
# monotonically_increasing_id() holds the row within the partition in these lowest bits.
ROW_BITS = 33


class Span(NamedTuple):
    """Smallest and largest key, and the number of keys if known; zeros without any."""

    low: int
    high: int
    rows: int | None = None


def key_spans(keyed: dict[str, tuple[DataFrame, str]]) -> dict[str, Span]:
    """Spans of several (frame, key), in one job."""
    bounds = [
        df.agg(F.min(key).cast("bigint").alias("low"), F.max(key).cast("bigint").alias("high"), F.count(key).alias("rows")).select(
            F.lit(name).alias("name"), "low", "high", "rows"
        )
        for name, (df, key) in keyed.items()
    ]
    found = reduce(DataFrame.union, bounds).collect()
    return {r["name"]: Span(r["low"] or 0, r["high"] or 0, r["rows"]) for r in found}


def number_by_range(df: DataFrame, key: str, name: str, first: int = 1) -> DataFrame:
    """Add ``name``: first, first+1, ... in the order of ``key``, unique and of any type with an order.

    Ranges of the key are sorted apart and written to the checkpoint folder with each row's position, which
    holds them fast; the rows in lower ranges, a number per shuffle partition, are then added. Neither a window nor
    a bucket sees more than its range.
    """
    ranged = df.repartitionByRange(F.col(key)).sortWithinPartitions(key)
    placed = kept(ranged.withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.withColumn("_range", F.shiftright("_at", ROW_BITS))
    counts = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    below = counts.select("_range", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("_below"))
    position = F.col("_at").bitwiseAND(F.lit((1 << ROW_BITS) - 1)) + F.col("_below") + F.lit(first)
    return placed.join(F.broadcast(below), "_range").withColumn(name, position.cast("bigint")).drop("_at", "_range", "_below")


def _rows_below(counts: DataFrame, low: int, high: int, bits: int) -> DataFrame:
    """From (bucket, rows), buckets in low..high, to (bucket, below): the rows in lower buckets.

    Up to 2**bits buckets fit one window. More are summed per group of 2**bits buckets, and the
    groups, numbered in the same way, add what lies below them.
    """
    so_far = F.sum("rows").over
    earlier = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    if high - low < 1 << bits:
        return counts.select("bucket", F.coalesce(so_far(earlier), F.lit(0)).alias("below"))
    group = F.shiftright("bucket", bits)
    groups = counts.groupBy(group.alias("bucket")).agg(F.sum("rows").alias("rows"))
    below_group = _rows_below(groups, low >> bits, high >> bits, bits)
    within = Window.partitionBy("group").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.withColumn("group", group)
        .withColumn("within", F.coalesce(so_far(within), F.lit(0)))
        .join(below_group.select(F.col("bucket").alias("group"), F.col("below").alias("below_group")), "group")
        .select("bucket", (F.col("within") + F.col("below_group")).alias("below"))
    )


def add_surrogate_key(
    df: DataFrame,
    key: str,
    name: str,
    span: Span | None = None,
    first: int = 1,
    bits: int = BUCKET_BITS,
) -> DataFrame:
    """Add ``name``: first, first+1, ... in the order of ``key``, a unique column without null.

    Keys other than integers, and integers that would leave most buckets nearly empty, are numbered by ranges
    (:func:`number_by_range`). ``span`` are bounds of the key when the caller knows them. A span below 2**bits is numbered by
    one window. Otherwise the key range is cut into buckets of 2**bits consecutive integers: rows
    are numbered per bucket, and the number of rows in lower buckets is added. No window ever sees
    more than 2**bits rows, and the bucket is a function of the key, so a recomputed task gives the
    same numbers.
    """
    if not isinstance(df.schema[key].dataType, T.IntegralType):
        return number_by_range(df, key, name, first)
    low, high, rows = Span(*span) if span else key_spans({key: (df, key)})[key]
    if high - low >= 1 << bits and rows is not None and rows < ((high - low) >> bits) * FILLED * (1 << bits):
        return number_by_range(df, key, name, first)
    if high - low < 1 << bits:
        position = F.row_number().over(Window.orderBy(key)).cast("bigint")
        return df.withColumn(name, position + F.lit(first - 1))
    bucket = F.shiftright(F.col(key).cast("bigint"), bits)
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows"))
    below = _rows_below(counts, low >> bits, high >> bits, bits)
    position = F.row_number().over(Window.partitionBy("_bucket").orderBy(key))
    return (
        df.withColumn("_bucket", bucket)
        .withColumn("_position", position)
        .join(below.select(F.col("bucket").alias("_bucket"), F.col("below").alias("_below")), "_bucket")
        .withColumn(name, (F.col("_position") + F.col("_below") + F.lit(first - 1)).cast("bigint"))
        .drop("_bucket", "_position", "_below")
    )


def next_id(df: DataFrame, key: str) -> DataFrame:
    """One row: the id after the largest one, 1 for an empty table."""
    return df.agg((F.coalesce(F.max(key), F.lit(0)) + 1).cast("bigint").alias("next_id"))


def append_with_ids(existing: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """Existing rows and the incoming ones with contiguous new ids in the order of ``order``.

    ``order`` is a unique column of ``incoming``.
    """
    first = next_id(existing, key).first()[0]
    numbered = add_surrogate_key(incoming, order, key, first=first)
    return existing.unionByName(numbered.select(*existing.columns))


def insert_if_absent(existing: DataFrame, seed: DataFrame, key: str) -> DataFrame:
    """Existing rows and those seed rows whose key is not there yet.

    The store is first reduced to the keys it shares with the seed, which needs no shuffle of the
    store when the seed is as small as seeds are.
    """
    present = existing.select(key).join(seed.select(key), key, "left_semi").distinct()
    return existing.unionByName(seed.join(present, key, "left_anti").select(*existing.columns))


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Per key the row with the smallest ``order``, combined before the shuffle. Null keys go."""
    others = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*others), F.col(order)).alias("_first")
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(first).select(key, "_first.*").select(*df.columns)


def append_new_natural_keys(existing: DataFrame, incoming: DataFrame, natural_key: str, order: str) -> DataFrame:
    """Existing rows and the incoming ones whose natural key is new in the store and among themselves."""
    fresh = first_per_key(incoming, natural_key, order)
    unseen = fresh.join(existing.select(natural_key), natural_key, "left_anti")
    return existing.unionByName(unseen.select(*existing.columns))
