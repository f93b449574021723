"""Referential checks and joins with asserted cardinality."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cofre.operators.keysets import KeySet, settle, wide_key
from cofre.operators.skew import join_parent


def missing(column: str) -> Column:
    """``column`` names no row of its parent, once :func:`attach_unmatched` has run."""
    return F.col(f"_unmatched_{column}").isNotNull()


@dataclass(frozen=True)
class Link:
    """Columns of a child that name rows of one parent by its key."""

    columns: tuple[str, ...]
    parent: DataFrame
    key: str


def unmatched_keys(child: DataFrame, link: Link) -> DataFrame:
    """Distinct values, as ``_key``, of the linked columns that name no row of the parent.

    Only distinct values travel, so neither a popular parent nor wide child rows cost a shuffle.
    """
    values = [wide_key(child, c) for c in link.columns]
    referred = child.select((F.explode(F.array(*values)) if len(values) > 1 else values[0]).alias("_key"))
    known = link.parent.select(wide_key(link.parent, link.key).alias("_known"))
    return referred.where("_key is not null").distinct().join(known, F.col("_key") == F.col("_known"), "left_anti")


def attach_unmatched(child: DataFrame, link: Link, unmatched: KeySet) -> DataFrame:
    """Make :func:`missing` known for the linked columns, from the settled :func:`unmatched_keys`."""
    for column in link.columns:
        child = unmatched.attach(child, column, f"_unmatched_{column}")
    return child


def attach_links(child: DataFrame, links: list[Link]) -> DataFrame:
    """Make :func:`missing` known for the columns of all links."""
    unmatched = settle({str(i): unmatched_keys(child, link) for i, link in enumerate(links)})
    for i, link in enumerate(links):
        child = attach_unmatched(child, link, unmatched[str(i)])
    return child


def rows_without_parent(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows of ``child`` whose ``column`` is set but names no row of ``parent``."""
    attached = attach_links(child, [Link((column,), parent, parent_key)])
    return attached.where(missing(column)).select(*child.columns)


def orphan_count(child: DataFrame, links: list[Link], name: str) -> DataFrame:
    """One row: how many rows of ``child`` lack at least one parent; a null reference lacks it too."""
    columns = [c for link in links for c in link.columns]
    attached = attach_links(child.select(*columns), links)
    lacks = [F.col(c).isNull() | missing(c) for c in columns]
    return attached.agg(F.count_if(reduce(Column.__or__, lacks)).alias(name))


def require_unique(df: DataFrame, key: str, what: str) -> DataFrame:
    """Fail at once when ``key`` repeats in ``df``."""
    if not df.groupBy(key).count().where("count > 1").isEmpty():
        raise ValueError(f"{what}: {key} is not unique")
    return df


def unique_or_fail(df: DataFrame, key: str) -> DataFrame:
    """``df`` with a check built into the plan: the query fails when ``key`` repeats.

    Grouping on the key that a join needs anyway spares the extra pass of :func:`require_unique`.
    """
    others = [c for c in df.columns if c != key]
    grouped = df.groupBy(key).agg(
        *[F.any_value(c).alias(c) for c in others],
        F.count(F.lit(1)).alias("_copies"),
    )
    single = F.assert_true(F.col("_copies") == 1, F.lit(f"{key} is not unique")).isNull()
    return grouped.where(single).select(key, *others)


def join_many_to_one(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join; fails when ``right_key`` repeats. Null keys match nothing.

    The check runs ahead of the join, so that the parents of hot keys are known to be few.
    """
    require_unique(right, right_key, "many-to-one join")
    return join_parent(left, right, left_key, right_key)
