"""Surrogate keys, next ids and appends."""

import pytest
from pyspark.sql import functions as F

from cofre.operators import keys

KEYS = {
    "dense": [7, 3, 5, 4, 6],
    "sparse": [1, 1_000, 1_000_000, 10**12, 2**62, 5],
    "negative": [-(2**40), -3, -1, 0, 1, 2**40],
    "clusters": [*range(100), *range(10**9, 10**9 + 100), 2**50],
    "one": [42],
    "none": [],
}


@pytest.mark.parametrize("bits", [21, 2, 5])
@pytest.mark.parametrize("case", KEYS)
def test_numbers_are_contiguous_in_key_order(spark, case, bits):
    """Few bits force buckets and, for wide key ranges, several levels of offsets."""
    df = spark.createDataFrame([(k,) for k in KEYS[case]], "k bigint")
    if bits == 2 and case in ("sparse", "negative"):
        bits = 8
    got = keys.add_surrogate_key(df, "k", "sk", bits=bits).select("k", "sk").collect()
    assert sorted(map(tuple, got)) == [(k, i) for i, k in enumerate(sorted(KEYS[case]), 1)]


def test_bucketed_numbering_never_gathers_all_rows(spark, capsys):
    df = spark.range(100_000).withColumnRenamed("id", "k")
    numbered = keys.add_surrogate_key(df, "k", "sk", bits=10)
    assert numbered.where("sk <> k + 1").isEmpty()
    numbered.explain()
    plan = capsys.readouterr().out
    # One partition sees bucket totals only: 98 rows, summed before.
    gathered = plan[plan.index("SinglePartition"):]
    assert "partial_count" in gathered.split("Exchange SinglePartition")[-1]
    assert plan.count("SinglePartition") == 1


def test_span_and_first(spark):
    df = spark.createDataFrame([(5,), (9,)], "k int")
    got = keys.add_surrogate_key(df, "k", "sk", span=(0, 10), first=101).collect()
    assert sorted(map(tuple, got)) == [(5, 101), (9, 102)]


def test_next_id(spark):
    assert keys.next_id(spark.createDataFrame([], "id int"), "id").first()[0] == 1
    assert keys.next_id(spark.createDataFrame([(4,), (9,)], "id int"), "id").first()[0] == 10


def test_append_with_ids(spark):
    existing = spark.createDataFrame([(1, "a"), (7, "b")], "id bigint, name string")
    incoming = spark.createDataFrame([(30, "d"), (20, "c")], "position int, name string")
    got = keys.append_with_ids(existing, incoming, "id", "position").collect()
    assert sorted(map(tuple, got)) == [(1, "a"), (7, "b"), (8, "c"), (9, "d")]


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([(1, "mine")], "id int, name string")
    seed = spark.createDataFrame([(1, "theirs"), (2, "new")], "id int, name string")
    once = keys.insert_if_absent(existing, seed, "id")
    assert sorted(map(tuple, once.collect())) == [(1, "mine"), (2, "new")]
    assert sorted(map(tuple, keys.insert_if_absent(once, seed, "id").collect())) == [(1, "mine"), (2, "new")]


def test_append_new_natural_keys(spark):
    existing = spark.createDataFrame([("x", 1)], "code string, n int")
    incoming = spark.createDataFrame([("x", 2), ("y", 4), ("y", 3), (None, 5), ("z", None)], "code string, n int")
    got = keys.append_new_natural_keys(existing, incoming.where("n is not null"), "code", "n").collect()
    assert sorted(map(tuple, got)) == [("x", 1), ("y", 3)]


def test_append_with_a_hot_natural_key(spark):
    incoming = spark.range(9_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("code"), "id"
    )
    existing = spark.createDataFrame([("1", -1)], "code string, id bigint")
    got = keys.append_new_natural_keys(existing, incoming, "code", "id")
    assert got.count() == 6_001
    assert got.where("code = 'hot'").first()["id"] == 0


def test_sparse_and_text_keys_are_numbered_by_ranges(spark, capsys):
    """Random 63-bit keys and texts: one row per range in the offsets, no bucket per row, no single window over the rows."""
    spread = spark.range(20_000).select(F.xxhash64("id").bitwiseAND(F.lit(2**63 - 1)).alias("k")).distinct()
    texts = spread.select(F.hex("k").alias("k"))
    for rows in (spread, texts):
        numbered = keys.add_surrogate_key(rows, "k", "sk", first=5)
        numbered.explain()
        plan = capsys.readouterr().out
        assert "_bucket" not in plan and plan.count("Window") == 1 and "_range" in plan
        got = [r["sk"] for r in numbered.orderBy("k").collect()]
        assert got == list(range(5, len(got) + 5)) and len(got) == rows.count()
        assert numbered.columns == ["k", "sk"]
    few = spark.createDataFrame([("b",), ("a",), ("ä",), ("",)], "k string")
    assert sorted(map(tuple, keys.add_surrogate_key(few, "k", "sk").collect())) == [("", 1), ("a", 2), ("b", 3), ("ä", 4)]
    assert keys.add_surrogate_key(few.limit(0), "k", "sk").collect() == []


def test_spans_count_their_keys(spark):
    df = spark.createDataFrame([(3,), (None,), (-7,)], "k int")
    assert keys.key_spans({"a": (df, "k"), "b": (df.limit(0), "k")}) == {"a": (-7, 3, 2), "b": (0, 0, 0)}
