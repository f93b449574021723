"""Key sets: the small facts about keys that decide what happens to wide rows.

Deduplication and reference checks first reduce the data to a set of keys that need attention
(repeated keys, keys without a parent). That set is cut off from its lineage by a checkpoint, its
size is counted, and only then are the wide rows looked up in it: not at all when it is empty, by
broadcast when it is known to be small, else by a shuffled join of those rows that a Bloom filter
of the set lets through. Clean data of any size is thus tagged without a shuffle of its wide rows.
"""

from __future__ import annotations

import tempfile
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cofre.operators import bloom

# Largest key set sent to every executor: about 100 MB as a hash table.
BROADCAST_ROWS = 1_000_000


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder that the session names; a local session without one gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        folder = tempfile.mkdtemp(prefix="cofre-checkpoint-")
    context.setCheckpointDir(folder)


def kept(df: DataFrame) -> DataFrame:
    """``df`` written to the checkpoint folder now, for a frame that several others read."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def wide_key(df: DataFrame, column: str) -> Column:
    """``column`` as key: integers as bigint, so that key sets of different tables fit together."""
    return F.col(column).cast("bigint") if isinstance(df.schema[column].dataType, T.IntegralType) else F.col(column)


@dataclass(frozen=True)
class KeySet:
    """A counted, durable set of unique keys, ``_key``, with an optional fact about each."""

    frame: DataFrame
    rows: int
    tied: int = 0

    @cached_property
    def _filter(self) -> bloom.BloomFilter:
        return bloom.build(self.frame, [F.col("_key")], self.rows)

    def attach(self, df: DataFrame, column: str, name: str, fact: str = "_key") -> DataFrame:
        """Add ``name``: the ``fact`` of the key in ``column``, null for a key outside the set."""
        absent = F.lit(None).cast(self.frame.schema[fact].dataType)
        if self.rows == 0:
            return df.withColumn(name, absent)
        hidden = f"_key{name}"
        side = self.frame.select(F.col("_key").alias(hidden), F.col(fact).alias(name))
        same = F.col(column) == F.col(hidden)
        if self.rows <= BROADCAST_ROWS:
            return df.join(F.broadcast(side), same, "left").drop(hidden)
        possible = F.coalesce(self._filter.may_contain(wide_key(df, column)) & F.col(column).isNotNull(), F.lit(False))
        looked_up = df.where(possible).join(side, same, "left").drop(hidden)
        return looked_up.unionByName(df.where(~possible).withColumn(name, absent))


def settle(parts: dict[str, DataFrame]) -> dict[str, KeySet]:
    """Compute narrow key sets in one go and keep them in the checkpoint folder; the same job counts them.

    All parts have a column ``_key``, of one type, and may have facts of their own; with a fact ``_tied`` the
    keys that have it are counted too.
    """
    named = [df.select(F.lit(name).alias("_part"), "*") for name, df in parts.items()]
    together = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), named)
    ensure_checkpoint_dir(together.sparkSession)
    tied = F.coalesce("_tied", F.lit(False)) if "_tied" in together.columns else F.lit(False)
    counted, counts = Observation(), []
    for i, name in enumerate(parts):
        of_part = F.col("_key").isNotNull() & (F.col("_part") == name)
        counts += [F.count_if(of_part).alias(f"rows_{i}"), F.count_if(of_part & tied).alias(f"tied_{i}")]
    present = together.observe(counted, *counts).checkpoint().where("_key is not null")
    found = counted.get
    return {
        name: KeySet(present.where(F.col("_part") == name), found[f"rows_{i}"], found[f"tied_{i}"]) for i, name in enumerate(parts)
    }
