"""Ordered quality rules: each row gets the first reason that applies, or none."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "_reject_reason"


def any_null(*columns: str | Column) -> Column:
    tests = [(F.col(c) if isinstance(c, str) else c).isNull() for c in columns]
    return reduce(Column.__or__, tests)


def not_positive(amount: Column) -> Column:
    """Null or not greater than zero."""
    return amount.isNull() | (amount <= 0)


def tag(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Add ``_reject_reason``: the text of the first rule whose condition holds, else null."""
    (text, condition), *rest = rules
    reason = F.when(condition, F.lit(text))
    for text, condition in rest:
        reason = reason.when(condition, F.lit(text))
    return df.withColumn(REASON, reason)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNotNull())
