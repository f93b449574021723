"""Key operators: newest row, repeated values, references, cardinality; also under skew."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cofre.operators import bloom, dedupe, keysets, references, skew
from cofre.operators.references import Link

DAY = [datetime(2026, 9, d) for d in range(1, 29)]
STAMPED = "id int, name string, _ingestion_timestamp timestamp_ntz, _row_seq bigint"


def names(df):
    return sorted(r["name"] for r in df.collect())


def test_split_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "id int, name string")
    valid, invalid = dedupe.split_null_keys(df, "id")
    assert (names(valid), names(invalid)) == (["a", "c"], ["b"])


def test_newest_row_wins(spark):
    rows = [(1, "new", DAY[5], 0), (1, "old", DAY[4], 1), (2, "only", DAY[3], 2), (None, "keyless", DAY[9], 3)]
    kept, rejected = dedupe.dedupe_latest(spark.createDataFrame(rows, STAMPED), "id")
    assert (names(kept), names(rejected)) == (["new", "only"], ["keyless", "old"])


def test_ties_go_to_the_last_row(spark):
    rows = [(1, "first", DAY[5], 0), (1, "last", DAY[5], 1)]
    kept, rejected = dedupe.dedupe_latest(spark.createDataFrame(rows, STAMPED), "id")
    assert (names(kept), names(rejected)) == (["last"], ["first"])


def test_missing_time_counts_as_newest(spark):
    rows = [(1, "undated", None, 0), (1, "dated", DAY[5], 1), (2, "undated a", None, 2), (2, "undated b", None, 3)]
    kept, _ = dedupe.dedupe_latest(spark.createDataFrame(rows, STAMPED), "id")
    assert names(kept) == ["undated", "undated b"]


def test_without_time_the_last_row_wins(spark):
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (None, "c", 2)], "id int, name string, _row_seq bigint")
    kept, rejected = dedupe.dedupe_latest(df, "id")
    assert (names(kept), names(rejected)) == (["b"], ["a", "c"])


def test_position_is_required(spark):
    with pytest.raises(ValueError, match="_row_seq"):
        dedupe.dedupe_latest(spark.createDataFrame([(1, "a")], "id int, name string"), "id")


def test_all_members_of_a_repeated_value(spark):
    df = spark.createDataFrame([("x", "a"), ("x", "b"), ("y", "c"), (None, "d"), (None, "e")], "v string, name string")
    assert names(dedupe.members_of_repeated(df, "v")) == ["a", "b"]


def _skewed(spark, n=30_000):
    """A third of all rows share one key."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), F.col("id").alias("_row_seq")
    )


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_dedupe_with_a_hot_key(spark, monkeypatch, limit):
    """Same result whether the repeated keys are broadcast or, beyond the bound, shuffled."""
    monkeypatch.setattr(keysets, "BROADCAST_ROWS", limit)
    kept, rejected = dedupe.dedupe_latest(_skewed(spark), "key")
    assert kept.count() == 20_001
    assert rejected.count() == 9_999
    assert kept.where("key = -1").first()["_row_seq"] == 29_997


def test_repeated_keys_are_combined_before_the_shuffle(spark, capsys):
    dedupe.repeated_keys(_skewed(spark), "key").explain()
    plan = capsys.readouterr().out
    assert "partial_count" in plan and "Window" not in plan
    assert plan.index("Exchange") < plan.index("partial_count")


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_rows_without_parent(spark, monkeypatch, limit):
    monkeypatch.setattr(keysets, "BROADCAST_ROWS", limit)
    child = _skewed(spark).select(F.col("_row_seq").alias("id"), F.col("key").alias("ref"))
    parent = spark.range(30_000).select(F.col("id").alias("pk"))
    missing = references.rows_without_parent(child, "ref", parent, "pk")
    assert missing.columns == ["id", "ref"]
    assert missing.count() == 10_000
    assert missing.where("ref <> -1").isEmpty()


def test_clean_references_need_no_join(spark, capsys):
    child = spark.range(10).select(F.col("id").alias("ref"))
    references.rows_without_parent(child, "ref", spark.range(10), "id").explain()
    assert "Join" not in capsys.readouterr().out


def test_null_reference_is_no_violation_but_an_orphan(spark):
    child = spark.createDataFrame([(1, 1), (2, None), (3, 9)], "id int, ref int")
    parent = spark.createDataFrame([(1,), (2,)], "pk int")
    assert [r["id"] for r in references.rows_without_parent(child, "ref", parent, "pk").collect()] == [3]
    assert references.orphan_count(child, [Link(("ref",), parent, "pk")], "n").first()["n"] == 2


def test_orphans_over_several_parents(spark):
    child = spark.createDataFrame([(1, 2, 5), (1, 9, 5), (9, 9, 9), (1, 1, 9)], "a int, b int, c int")
    left = spark.createDataFrame([(1,), (2,)], "pk int")
    right = spark.createDataFrame([(5,)], "pk bigint")
    links = [Link(("a", "b"), left, "pk"), Link(("c",), right, "pk")]
    assert references.orphan_count(child, links, "n").first()["n"] == 3


def test_many_to_one_join(spark):
    left = spark.createDataFrame([(1, 1), (2, 1), (3, None), (4, 7)], "id int, ref int")
    right = spark.createDataFrame([(1, "a"), (2, "b")], "pk int, name string")
    joined = references.join_many_to_one(left, right, "ref", "pk")
    assert sorted(map(tuple, joined.collect())) == [(1, 1, "a"), (2, 1, "a")]
    with pytest.raises(ValueError, match="pk is not unique"):
        references.join_many_to_one(left, right.union(right), "ref", "pk")


def test_unique_or_fail(spark):
    once = spark.createDataFrame([(1, "a"), (2, None)], "pk int, name string")
    assert sorted(map(tuple, references.unique_or_fail(once, "pk").collect())) == [(1, "a"), (2, None)]
    twice = once.union(once)
    with pytest.raises(PySparkException, match="pk is not unique"):
        references.unique_or_fail(twice, "pk").select("pk").collect()


def test_hot_join_keys_meet_their_parents_by_broadcast(spark, capsys):
    """The shuffled side holds no row of a hot key, and the result is that of a plain join."""
    left = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(F.col("id")).alias("ref"), F.hash("id").alias("payload")
    )
    right = spark.range(1, 25_000).select(F.col("id").alias("pk"), (F.col("id") * 2).alias("fact"))
    hot = skew.hot_keys(left, "ref", share=0.05)["ref"]
    assert 1 in hot and len(hot) <= 20 and None not in hot
    joined = references.join_many_to_one(left, right, "ref", "pk")
    assert joined.columns == ["ref", "payload", "fact"]
    wanted = left.join(right, F.col("ref") == F.col("pk")).select("ref", "payload", "fact")
    assert joined.count() == wanted.count() and joined.exceptAll(wanted).isEmpty()
    joined.explain()
    plan = capsys.readouterr().out
    assert "Union" in plan and "BroadcastHashJoin" in plan
    assert skew.join_parent(left, right, "ref", "pk", hot=[]).count() == wanted.count()


def test_parents_of_hot_keys_that_are_many_are_not_broadcast(spark, monkeypatch, capsys):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 3)
    left, right = spark.range(100).selectExpr("1 as ref"), spark.range(5).selectExpr("1 as pk", "id")
    joined = skew.join_parent(left, right, "ref", "pk", hot=[1])
    assert joined.count() == 500
    joined.explain()
    assert "Union" not in capsys.readouterr().out


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_bloom_filter_misses_no_key(spark, kind):
    keys = spark.range(0, 40_000, 2).select(F.col("id").cast(kind).alias("k"))
    built = bloom.build(keys, [F.col("k")], 20_000)
    asked = spark.range(-10_000, 50_000).select(F.col("id").cast(kind).alias("k"), "id").withColumn("may", built.may_contain(F.col("k")))
    even = (F.col("id") % 2 == 0) & F.col("id").between(0, 39_999)
    counts = asked.agg(F.count_if(even & ~F.col("may")), F.count_if(~even & F.col("may")), F.count_if(~even)).first()
    assert counts[0] == 0 and counts[1] < 0.05 * counts[2]
    empty = bloom.build(keys.limit(0), [F.col("k")], 0)
    assert keys.where(empty.may_contain(F.col("k"))).isEmpty()


def test_beyond_the_bound_only_possible_matches_are_exchanged(spark, monkeypatch):
    """The wide rows of most keys keep out of every exchange; the result stays the same."""
    monkeypatch.setattr(keysets, "BROADCAST_ROWS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = spark.range(0, 20_000, 1, 4).select(
            F.when(F.col("id") % 100 == 0, F.col("id") + 1).otherwise(F.col("id")).cast("int").alias("key"), F.col("id").alias("_row_seq"),
            F.repeat(F.lit("x"), 200).alias("payload"),
        )
        wide = wide.unionAll(wide.limit(0)).unionAll(spark.range(3).selectExpr("cast(null as int)", "id", "'none'"))
        latest, older = dedupe.dedupe_latest(wide, "key")
        assert (latest.count(), older.count()) == (19_800, 203)
        execution = latest._jdf.queryExecution()
        latest.collect()
        plan = execution.executedPlan().toString()
        assert "xxhash64" in plan and "Union" in plan
        repeated = keysets.settle({"r": dedupe.repeated_keys(wide, "key")})["r"]
        assert repeated.rows == 200
        passed = wide.where(repeated._filter.may_contain(keysets.wide_key(wide, "key"))).count()
        assert 400 <= passed < 0.1 * 20_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ties_are_found_within_the_key_set(spark, monkeypatch):
    """No wide row is read again for them, and older copies may tie."""
    rows = [(1, "a", DAY[1], 5), (1, "b", DAY[1], 5), (2, "c", DAY[1], 1), (2, "d", DAY[1], 1), (2, "e", DAY[2], 0), (3, "f", None, 1), (3, "g", None, 1)]
    given = spark.createDataFrame(rows, "id int, name string, _ingestion_timestamp timestamp_ntz, _row_seq bigint")
    found = dedupe.repeated_keys(given, "id")
    assert {r["_key"]: r["_tied"] for r in found.collect()} == {1: True, 2: False, 3: True}
    assert keysets.settle({"x": found, "y": found.limit(0)})["x"].tied == 2
    kept, _ = dedupe.dedupe_latest(given.where("id = 2"), "id")
    assert names(kept) == ["e"]
    hot = spark.range(0, 50_000, 1, 8).selectExpr("1 as id", "id div 2 as _row_seq")
    with pytest.raises(ValueError, match="have id 1"):
        dedupe.dedupe_latest(hot, "id")


def test_rows_that_are_equally_new_are_refused(spark):
    rows = [(1, "a", 5), (1, "b", 5), (2, "c", 1), (2, "d", 2)]
    tied = spark.createDataFrame(rows, "id int, text string, _row_seq bigint")
    with pytest.raises(ValueError, match="_row_seq"):
        dedupe.dedupe_latest(tied, "id")
    latest, older = dedupe.dedupe_latest(tied.where("text <> 'a'"), "id")
    assert sorted(r.text for r in latest.collect()) == ["b", "d"]
    assert [r.text for r in older.collect()] == ["c"]
