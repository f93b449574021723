"""What the operators of this package share: tables, scratch tables, text forms, bounded broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cofre.operators import bloom

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Most rows, and most bytes when written out, of a table that is broadcast; a larger one is joined by shuffle.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20


def ship(spark: SparkSession) -> None:
    """Send the library's modules along, once per application, so that Python workers anywhere can import them."""
    context = spark.sparkContext
    if getattr(context, "_cofre_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="cofre-ship-")) / "cofre-modules.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._cofre_shipped = True


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty text."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, UPPER.lower())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("Set spark.checkpoint.dir to a folder that all executors share.")
        folder = tempfile.mkdtemp(prefix="cofre-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scratch:
    """Tables of one run in the shared folder. They cut lineage and outlive lost executors.

    A table stays until :meth:`drop`; what a returned frame still reads is left to whoever empties the folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{shared_folder(spark)}/cofre-llm/{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.path}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(conf).delete(path, True)


def weigh(df: DataFrame) -> tuple[int, bool]:
    """The rows of ``df``, and whether they are few and short enough for a broadcast."""
    written = df.select(F.octet_length(F.to_json(F.struct(*[df[c] for c in df.columns]))).cast("long").alias("n")) if df.columns else df
    found = written.agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("bytes")).first()
    return found["rows"], found["rows"] <= BROADCAST_ROWS and (found["bytes"] or 0) <= BROADCAST_BYTES


def bounded(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast when its measured size allows it, else as it is."""
    return F.broadcast(df) if weigh(df)[1] else df


def join_few(wide: DataFrame, few: DataFrame, on: list[tuple[Column, str]], how: str = "inner") -> DataFrame:
    """Wide rows joined (inner or left_semi) with ``few`` narrow ones on equal or equally null values: by broadcast, or
    beyond its bound by a shuffle of those wide rows that a Bloom filter of the others lets through.

    ``on``: values of ``wide`` and the columns of ``few`` they must equal, of one type.
    """
    same = reduce(Column.__and__, [value.eqNullSafe(F.col(name)) for value, name in on])
    rows, small = weigh(few)
    if small:
        return wide.join(F.broadcast(few), same, how)
    return wide.where(_possible(few, on, rows)).join(few, same, how)


def _possible(few: DataFrame, on: list[tuple[Column, str]], rows: int) -> Column:
    return bloom.build(few, [F.col(name) for _, name in on], rows).may_contain(*[value for value, _ in on])


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str = "size") -> DataFrame:
    """``rows`` joined with the row of their group. ``groups``, a written table, has the number of its rows in ``size``, which is dropped.

    A group that holds half an average shuffle partition or more is met by broadcast (there are at most twice as many of these as
    partitions), so its rows stay where they are; only the others are dealt by group.
    """
    n_rows = groups.agg(F.sum(size)).first()[0] or 0
    limit = n_rows / (2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    large = groups.where(F.col(size) >= max(limit, 2)).drop(size)
    others = rows.join(F.broadcast(large.select(*on)), on, "left_anti").join(groups.where(F.col(size) < max(limit, 2)).drop(size), on)
    return rows.join(F.broadcast(large), on).unionByName(others)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, rows: DataFrame, key: str, row_hash: Column, how: str = "left_anti") -> DataFrame:
    """The rows of ``df`` that are not among ``rows`` (key, row_hash), or with ``left_semi`` those that are."""
    key_name, hash_name = free_name(df, "_key"), free_name(df, "_hash")
    sought = rows.select(F.col("key").alias(key_name), F.col("row_hash").alias(hash_name)).distinct()
    on = [(df[key], key_name), (row_hash, hash_name)]
    if how == "left_semi":
        return join_few(df, sought, on, how)
    same = df[key].eqNullSafe(F.col(key_name)) & (row_hash == F.col(hash_name))
    n_rows, small = weigh(sought)
    if small:
        return df.join(F.broadcast(sought), same, how)
    possible = _possible(sought, on, n_rows)
    return df.where(possible).join(sought, same, how).unionAll(df.where(~possible))


def keep_rows(df: DataFrame, decisions: DataFrame, key: str, row_hash: Column) -> DataFrame:
    """The rows of ``df`` that stay, with all its columns as they were.

    ``decisions``: key, row_hash, kept, a row for each row of ``df``. Rows that go are looked up, as they are the fewer. Of
    repeated rows of which only some stay, one stays; of those that all stay, all do.
    """
    scratch = Scratch(df.sparkSession, "decisions")
    pairs = decisions.groupBy("key", "row_hash").agg(F.count_if("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    odd = scratch.write(pairs.where("kept < n"), "odd")
    stays = without(df, odd.where("kept = 0"), key, row_hash)
    repeated = odd.where("kept > 0")
    if repeated.isEmpty():
        return stays
    once = without(stays, repeated, key, row_hash)
    several = without(stays, repeated, key, row_hash, "left_semi")
    key_name, hash_name = free_name(df, "_key"), free_name(df, "_hash")
    marked = several.withColumns({key_name: several[key], hash_name: row_hash})
    return once.unionAll(marked.dropDuplicates([key_name, hash_name]).drop(key_name, hash_name))
