"""Joins to a parent table where few keys hold many of the rows.

Hot keys are found in one pass over the key column, their few parent rows are broadcast, and only the other rows are
shuffled. So no shuffle partition gets more than its share, whatever adaptive execution makes of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofre.operators.keysets import BROADCAST_ROWS, wide_key

#: freqItems takes no smaller share.
LEAST_SHARE = 1e-4


def hot_share(df: DataFrame) -> float:
    """The share of all rows from which on a key is hot: half an average shuffle partition."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1 / (2 * partitions), LEAST_SHARE)


def hot_keys(df: DataFrame, *columns: str, share: float | None = None) -> dict[str, list]:
    """Per column the keys that hold more than ``share`` of the rows: at most 1/share of them, some colder ones may be among them.

    The frequent-items summary never misses such a key and keeps 1/share counters per task and column, so one pass
    without a shuffle of the keys finds all.
    """
    keys = df.select(*[wide_key(df, c).alias(c) for c in columns])
    found = keys.stat.freqItems(list(columns), share or hot_share(df)).first()
    return {c: sorted(k for k in found[f"{c}_freqItems"] or [] if k is not None) for c in columns}


def join_parent(left: DataFrame, right: DataFrame, left_key: str, right_key: str, hot: list | None = None) -> DataFrame:
    """Inner join to the parents in ``right``, whose ``right_key`` is dropped. Null keys match nothing.

    ``hot``: the hot keys of ``left``, if the caller knows them. Rows with a hot key meet their parents by broadcast, the others by
    whatever the optimiser chooses. Should the parents of hot keys be too many for that, as their key repeats, nothing is split.
    """
    hot = hot_keys(left, left_key)[left_key] if hot is None else hot
    parents = right.withColumnRenamed(right_key, "_parent")
    same = F.col(left_key) == F.col("_parent")

    def joined(rows: DataFrame, to: DataFrame) -> DataFrame:
        return rows.join(to, same).drop("_parent")

    if not hot:
        return joined(left, parents)
    few = parents.where(F.col("_parent").isin(hot))
    if few.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        return joined(left, parents)
    is_hot = F.col(left_key).isin(hot)
    rest = joined(left.where(~is_hot), parents.where(~F.col("_parent").isin(hot)))
    return joined(left.where(is_hot), F.broadcast(few)).unionAll(rest)
