"""Null keys, repeated keys and the newest row of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cofre.functions.clean import instant_to_utc
from cofre.operators.keysets import KeySet, settle, wide_key
from cofre.schemas import INGESTED_AT, ROW_SEQ

def split_null_keys(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a key and rows without one."""
    return df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())


def recency(df: DataFrame) -> Column:
    """Sort value of a row: ingestion time with null as newest, then position in the input.

    ``_row_seq`` is unique within the table (given at ingestion), so no two rows compare equal.
    Without ingestion time the position decides alone.
    """
    if ROW_SEQ not in df.columns:
        raise ValueError(f"Column {ROW_SEQ} is needed to tell which row came last.")
    moment = F.lit(None)
    undated = F.lit(False)
    if INGESTED_AT in df.columns:
        moment = F.col(INGESTED_AT)
        undated = moment.isNull()
        if isinstance(df.schema[INGESTED_AT].dataType, T.TimestampType):
            moment = instant_to_utc(moment)
    return F.struct(
        undated.alias("undated"),
        moment.cast("timestamp_ntz").alias("moment"),
        F.col(ROW_SEQ).cast("bigint").alias("position"),
    )


def repeated_keys(df: DataFrame, key: str, among: Column | None = None) -> DataFrame:
    """Keys held by more than one row, as ``_key``, with the recency of the newest of these rows (``_newest``) and
    whether several are equally new (``_tied``).

    Only rows that meet ``among`` count. An aggregate rather than a window: copies are combined
    before the shuffle, so a key that holds a third of the table costs one row per task. Rows left
    out form one group without key rather than being filtered, which would compute the condition
    twice; no lookup ever finds that group. Of equally new rows the largest and the smallest number are kept: they differ
    when there are several.
    """
    group = wide_key(df, key) if among is None else F.when(among, wide_key(df, key))
    rows = df.select(group.alias("_key"), recency(df).alias("_recency"), F.monotonically_increasing_id().alias("_number"))
    return (
        rows.groupBy("_key")
        .agg(
            F.count(F.lit(1)).alias("_copies"),
            F.max(F.struct("_recency", F.col("_number").alias("n"))).alias("_high"),
            F.max(F.struct("_recency", (-F.col("_number")).alias("n"))).alias("_low"),
        )
        .where("_copies > 1")
        .select("_key", F.col("_high._recency").alias("_newest"), (F.col("_high.n") != -F.col("_low.n")).alias("_tied"))
    )


def older_copy(df: DataFrame, newest: str = "_newest") -> Column:
    """The row shares its key with a newer one, by the attached recency of the newest."""
    return F.coalesce(recency(df) != F.col(newest), F.lit(False))


def superseded(df: DataFrame, key: str, newest: str = "_newest") -> Column:
    """The key is null, or a newer row has the same key."""
    return F.col(key).isNull() | older_copy(df, newest)


def refuse_ties(repeated: KeySet, key: str) -> KeySet:
    """Fail when two rows of a key are equally new; the key set knows, so no row is read again."""
    if repeated.tied:
        tied = repeated.frame.where("_tied").first()["_key"]
        raise ValueError(f"{ROW_SEQ} is not unique: several newest rows have {key} {tied}.")
    return repeated


def dedupe_latest(df: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """The one newest row of each key, and all other rows (older copies and null keys).

    Rows that cannot be told apart by time and position are an error, as either might be the newest.
    """
    repeated = refuse_ties(settle({"repeated": repeated_keys(df, key)})["repeated"], key)
    attached = repeated.attach(df, key, "_newest", "_newest")
    lost = superseded(df, key)
    return attached.where(~lost).drop("_newest"), attached.where(lost).drop("_newest")


def members_of_repeated(df: DataFrame, key: str) -> DataFrame:
    """All rows of every key that more than one row holds."""
    copies = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_copies"))
    shared = settle({"shared": copies.where("_copies > 1")})["shared"]
    return shared.attach(df, key, "_shared").where("_shared is not null").drop("_shared")
