"""Bloom filters of key sets, built and asked with built-in functions.

Two hashes of a key set two bits. The bits are 64-bit words, combined per word before the shuffle, and reach the tasks that ask as one array: the
value of a scalar subquery, computed once. What passes may be in the set, what doesn't pass certainly isn't.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits per key, and most bits of a filter (32 MB). A larger set still gets a right filter, one that lets more through.
BITS_PER_KEY, MOST_BITS = 16, 1 << 28
LEAST_BITS = 1 << 10
SEEDS = (11, 23)


def _places(keys: list[Column], bits: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), *keys).bitwiseAND(F.lit(bits - 1)) for seed in SEEDS]


@dataclass(frozen=True)
class BloomFilter:
    """``words``: one row with the array of words."""

    words: DataFrame
    bits: int

    def may_contain(self, *keys: Column) -> Column:
        """The keys, of the types the filter was built from, may be in the set."""
        words = self.words.scalar()

        def is_set(place: Column) -> Column:
            # Arrays start at 1. The lowest six bits say which bit of the word.
            word = F.element_at(words, (F.shiftrightunsigned(place, 6) + 1).cast("int"))
            shifted = F.call_function("shiftrightunsigned", word, place.bitwiseAND(F.lit(63)).cast("int"))
            return shifted.bitwiseAND(F.lit(1)) == 1

        first, second = _places(list(keys), self.bits)
        return is_set(first) & is_set(second)


def build(df: DataFrame, keys: list[Column], rows: int) -> BloomFilter:
    """The filter of the ``keys`` of all rows of ``df``, sized for ``rows`` of them."""
    wanted = min(max(rows * BITS_PER_KEY, LEAST_BITS), MOST_BITS)
    bits = 1 << (wanted - 1).bit_length()
    place = F.explode(F.array(*_places(keys, bits))).alias("place")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place").bitwiseAND(F.lit(63)).cast("int"))
    asked = df.select(place).select(F.shiftrightunsigned("place", 6).alias("word"), bit.alias("value"))
    none = df.sparkSession.range(bits >> 6).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("value"))
    words = asked.unionAll(none).groupBy("word").agg(F.bit_or("value").alias("value"))
    # Put together in two steps, so that the last one meets few and long pieces.
    pieces = words.groupBy(F.shiftright("word", 10).alias("piece")).agg(_in_order("word", "value").alias("values"))
    return BloomFilter(pieces.agg(F.flatten(_in_order("piece", "values")).alias("words")), bits)


def _in_order(number: str, value: str) -> Column:
    """The values of a group by their number."""
    return F.transform(F.array_sort(F.collect_list(F.struct(number, value))), lambda pair: pair[value])
