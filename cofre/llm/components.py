"""Connected components by alternating large and small stars.

Every step is a minimum per node (combined before the shuffle) and a join, so a node with a third of all links is
split like any skewed join key. Links of each step are written to the shared folder; no links reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cofre.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """``links``: a, b (bigint, any order). Gives node, component (its smallest node) for all nodes but the smallest."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = scratch.write(edges, f"{name}-0")
    state, step = _state(edges), 0
    while state[0]:
        step += 1
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = scratch.write(small.union(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{step}")
        before, state = state, _state(following)
        scratch.drop(f"{name}-{step - 1}")
        edges = following
        if before == state:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _state(edges: DataFrame) -> tuple[int, int]:
    """Number and checksum of the links: equal when a step changed nothing."""
    found = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return found["n"], found["x"]
