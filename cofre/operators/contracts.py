"""Data contracts: one row per check with the number of violations, passed when that is 0."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Models = Mapping[str, DataFrame]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _result(model, column, check: str, violations) -> list[Column]:
    return [
        model.alias("model"),
        column.alias("column"),
        F.lit(check).alias("check"),
        violations.cast("bigint").alias("violations"),
    ]


def not_null(models: Models, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Null values per listed column, one pass per model."""

    def counted(model: str) -> DataFrame:
        counts = models[model].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns[model]])
        pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("violations")) for c in columns[model]]
        return counts.select(F.inline(F.array(*pairs))).select(
            *_result(F.lit(model), F.col("column"), "not_null", F.col("violations"))
        )

    return union_all([counted(model) for model in columns])


def not_null_counted(models: Models, columns: Mapping[str, Sequence[str]], nulls: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """The same from null values that were counted when the models were written; a listed column that wasn't counted is an error."""
    rows = [(model, column, "not_null", nulls[model][column]) for model, listed in columns.items() for column in listed]
    spark = next(iter(models.values())).sparkSession
    return spark.createDataFrame(rows, "model string, column string, check string, violations bigint")


def _stacked(df: DataFrame, numbered: Mapping[int, str], kind: str) -> DataFrame:
    """(check, value) for every non-null value of the columns, by the number of their check."""
    pairs = [F.struct(F.lit(i).alias("check"), F.col(c).cast(kind).alias("value")) for i, c in numbered.items()]
    return df.select(F.inline(F.array(*pairs))).where("value is not null")


def _named(found: DataFrame, check: str, numbered: Sequence[tuple[str, str]]) -> DataFrame:
    """All checks by model and column, those that found nothing included.

    ``found`` has at most one row per check number.
    """
    every = [(i, model, column) for i, (model, column) in enumerate(numbered)]
    frame = found.sparkSession.createDataFrame(every, "check int, model string, column string")
    violations = F.coalesce("violations", F.lit(0))
    return frame.join(F.broadcast(found), "check", "left").select(
        *_result(F.col("model"), F.col("column"), check, violations)
    )


#: A bitmap of bitmap_construct_agg stands for 32768 integers in 4 KB. From so many values a bitmap on it is no larger than them.
WORTH_A_BITMAP = 512


def _stacked_by_kind(models: Models, columns: Mapping[str, Sequence[str]], numbered: Sequence[tuple[str, str]]) -> dict[str, DataFrame]:
    """(check, value) of all columns, one frame for integers and one for other types."""
    of_kind: dict[str, list[DataFrame]] = {}
    for model in columns:
        schema = models[model].schema
        by_kind: dict[str, dict[int, str]] = {}
        for i, (owner, column) in enumerate(numbered):
            if owner == model:
                kind = "bigint" if isinstance(schema[column].dataType, T.IntegralType) else "string"
                by_kind.setdefault(kind, {})[i] = column
        for kind, listed in by_kind.items():
            of_kind.setdefault(kind, []).append(_stacked(models[model], listed, kind))
    return {kind: union_all(frames) for kind, frames in of_kind.items()}


def _dense(values: DataFrame) -> list[int]:
    """Checks whose integers lie so close together in each task that bitmaps of them are smaller than they are.

    Bitmaps are counted approximately, which needs no shuffle of keys; the count only chooses a way.
    """
    bitmap = F.struct(F.spark_partition_id().alias("task"), F.bitmap_bucket_number("value").alias("bucket")).alias("bitmap")
    held = values.select("check", "value", bitmap).groupBy("check")
    found = held.agg(F.count("value").alias("rows"), F.approx_count_distinct("bitmap").alias("bitmaps"))
    return [r["check"] for r in found.collect() if r["rows"] >= WORTH_A_BITMAP * r["bitmaps"]]


def _bitmap_counts(values: DataFrame) -> DataFrame:
    """check, rows and distinct values, by way of bitmaps: tasks send bitmaps, not values."""
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bits")
    per = values.groupBy("check", F.bitmap_bucket_number("value").alias("bucket")).agg(bits, F.count("value").alias("rows"))
    return per.groupBy("check").agg(F.sum("rows").alias("rows"), F.sum(F.bitmap_count("bits")).alias("distinct_values"))


def unique(models: Models, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values that occur more than once, per listed column.

    Integers that lie close together are counted in bitmaps first: where rows and distinct values agree, nothing
    occurs twice and no value is shuffled. Of all other columns nothing but check number and value is, in one shuffle per kind of type.
    """
    numbered = [(model, column) for model, listed in columns.items() for column in listed]
    of_kind = _stacked_by_kind(models, columns, numbered)
    if "bigint" in of_kind:
        dense = _dense(of_kind["bigint"])
        counted = _bitmap_counts(of_kind["bigint"].where(F.col("check").isin(dense))).collect() if dense else []
        sound = [r["check"] for r in counted if r["rows"] == r["distinct_values"]]
        of_kind["bigint"] = of_kind["bigint"].where(~F.col("check").isin(sound)) if sound else of_kind["bigint"]
    repeated = [values.groupBy("check", "value").count().where("count > 1").select("check") for values in of_kind.values()]
    found = union_all(repeated).groupBy("check").agg(F.count(F.lit(1)).alias("violations"))
    return _named(found, "unique", numbered)


def relationships(models: Models, links: Mapping[str, Sequence[tuple[str, str, str]]]) -> DataFrame:
    """Rows whose column names no parent row, per (column, parent, parent column) of each model.

    One join per parent key: the values of all columns that refer to it are counted, so a popular
    parent is one row per task, and then looked up. An outer join, as an anti join may be moved
    below the count and into every child.
    """
    numbered = [(model, *link) for model, listed in links.items() for link in listed]
    unmatched = []
    for target in dict.fromkeys((parent, key) for _, _, parent, key in numbered):
        children: dict[str, dict[int, str]] = {}
        for i, (model, column, *named) in enumerate(numbered):
            if tuple(named) == target:
                children.setdefault(model, {})[i] = column
        used = union_all([_stacked(models[model], listed, "bigint") for model, listed in children.items()])
        counted = used.groupBy("check", "value").count()
        known = models[target[0]].select(F.col(target[1]).cast("bigint").alias("value"), F.lit(True).alias("known"))
        unmatched.append(counted.join(known, "value", "left").where("known is null").select("check", "count"))
    found = union_all(unmatched).groupBy("check").agg(F.sum("count").alias("violations"))
    return _named(found, "relationships", [(model, column) for model, column, _, _ in numbered])


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Number of rows per table."""
    return union_all([
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ])


def uniqueness_counts(df: DataFrame, column: str) -> DataFrame:
    """One row: rows, and distinct values of ``column``; integers that lie close together are counted in bitmaps."""
    if isinstance(df.schema[column].dataType, T.IntegralType):
        values = df.select(F.lit(0).alias("check"), F.col(column).cast("bigint").alias("value"))
        if _dense(values):
            bits = F.bitmap_construct_agg(F.bitmap_bit_position("value")).alias("bits")
            per = values.groupBy(F.bitmap_bucket_number("value").alias("bucket")).agg(bits, F.count(F.lit(1)).alias("rows"))
            return per.agg(F.sum("rows").alias("total"), F.sum(F.bitmap_count("bits")).alias("distinct_values"))
    return df.agg(F.count(F.lit(1)).alias("total"), F.count_distinct(column).alias("distinct_values"))


def violation_count(df: DataFrame, condition, name: str) -> DataFrame:
    """One row: how many rows meet ``condition``."""
    return df.agg(F.count_if(condition).alias(name))
