from pyspark.sql import functions as F

from cofre.llm import common, exact_dedup, near_duplicates


def test_equal_rows_without_text_all_stay(documents):
    rows = [(1, None), (1, None), (2, ""), (2, ""), (3, "same text here"), (3, "same text here"), (4, "same text here")]
    stay = near_duplicates.drop_near_duplicates(documents(rows), words=2)
    assert sorted((r.doc_id, r.text) for r in stay.where("text is not null").collect()) == [(2, ""), (2, ""), (3, "same text here")]
    assert stay.where("text is null").count() == 2


def test_beyond_the_bound_only_possible_rows_are_exchanged(spark, documents, monkeypatch):
    """Of 3,000 texts, those that go and few others meet a shuffle; the result stays the same."""
    rows = [(i, f"text number {i % 2900} " * 20) for i in range(3000)]
    wanted = sorted(r.doc_id for r in exact_dedup.drop_duplicates(documents(rows)).collect())
    monkeypatch.setattr(common, "BROADCAST_ROWS", 1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = documents(rows)
        assert sorted(r.doc_id for r in exact_dedup.drop_duplicates(df).collect()) == wanted
        gone = df.where("doc_id < 100").select(F.col("doc_id").alias("key"), F.xxhash64("text").alias("row_hash"))
        for how, n in (("left_anti", 2900), ("left_semi", 100)):
            found = common.without(df, gone, "doc_id", F.xxhash64("text"), how)
            assert found.count() == n and found.columns == df.columns
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("Join") < plan.index("scalar-subquery") and "Filter" in plan
        few = gone.withColumnsRenamed({"key": "k", "row_hash": "h"})
        on = [(df["doc_id"], "k"), (F.xxhash64(df["text"]), "h")]
        assert common.join_few(df, few, on).count() == 100
        assert df.where(common._possible(few, on, 100)).count() < 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_keys_are_found_beyond_the_bound(documents, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    df = documents([(None, "a"), (None, "b"), (1, None), (1, "c")])
    gone = df.where("doc_id is null or text is null").select(F.col("doc_id").alias("key"), F.xxhash64("text").alias("row_hash"))
    assert [r.text for r in common.without(df, gone, "doc_id", F.xxhash64("text")).collect()] == ["c"]


def test_large_groups_stay_where_they_are(spark):
    """A group with a third of all rows is met by broadcast; the shuffled side doesn't hold it."""
    rows = spark.range(0, 9000, 1, 6).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 700).alias("g"), "id")
    groups = rows.groupBy("g").agg(F.count(F.lit(1)).alias("size"), F.min("id").alias("least"))
    groups = common.Scratch(spark, "test").write(groups, "groups")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = common.join_groups(rows, groups, ["g"])
        wanted = rows.join(groups.drop("size"), "g")
        assert found.columns == ["g", "id", "least"] and found.count() == 9000 and found.exceptAll(wanted).isEmpty()
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) <= 2 * 9000 / 6
        assert common.join_groups(rows.limit(0), groups.limit(0), ["g"]).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
