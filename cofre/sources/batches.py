"""Layers on a shared file system: a folder per table, batch and attempt, and a log of commits.

A batch may be written again. Every attempt has folders of its own, and a commit names the attempt that counts from
now on, so a rerun touches nothing that a reader holds: who chose the batch before goes on with the old attempt.

The commit log is a sequence of numbered entries without gaps. An entry is created under the next number, which fails when another process
was first and is then tried again. Every :data:`COMPACT_EVERY` commits the log so far is compacted into one table, named by a hint; a
reader takes the hint, that table, and the entries after it, so it reads a constant number of files, whatever the age of the lake.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cofre.schemas import TABLES
from cofre.sources.files import Files

logger = logging.getLogger(__name__)

_WRITES = "table_name string, row_count bigint, null_counts map<string, bigint>, columns string"
_COMMITS = (
    "number bigint, batch_id string, ingestion_date string, ingestion_ts timestamp_ntz, attempt string, committed_at timestamp_ntz, "
    "table_name string, row_count bigint"
)
#: Commits from one compaction of the log to the next.
COMPACT_EVERY = 20
_HINT = "compacted.json"


def utc_now() -> datetime:
    """Current UTC time without zone, as the logs keep it."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass(frozen=True)
class Batch:
    """A snapshot of all source tables, and the attempt at it that a layer wrote or committed."""

    batch_id: str
    ingested_at: datetime
    attempt: str | None = field(default=None, compare=False)

    @property
    def ingestion_date(self) -> str:
        return self.ingested_at.date().isoformat()


def batch_ids(manifest: DataFrame, table: str) -> DataFrame:
    """Batches in which ``table`` was written."""
    return manifest.where(F.col("table_name") == table).select("batch_id").distinct()


def complete_batches(manifest: DataFrame) -> DataFrame:
    """Batches in which every source table was written, with their ingestion time, commit state and commit time."""
    return (
        manifest.where(F.col("table_name").isin(*TABLES))
        .groupBy("batch_id")
        .agg(
            F.count_distinct("table_name").alias("_tables"),
            F.min("ingestion_ts").alias("ingestion_ts"),
            F.bool_and("committed").alias("committed"),
            F.max("committed_at").alias("committed_at"),
        )
        .where(F.col("_tables") == len(TABLES))
        .drop("_tables")
    )


def latest_batch(batches: DataFrame, time: str = "ingestion_ts") -> DataFrame:
    """The newest batch, by time and then by id; no row when there is none."""
    newest = F.max_by(F.struct("batch_id", time), F.struct(time, "batch_id")).alias("_newest")
    return batches.agg(newest).where("_newest is not null").select("_newest.*")


@dataclass(frozen=True)
class Written:
    """What the log keeps about one written table."""

    row_count: int
    null_counts: dict[str, int]
    schema: T.StructType


class CommitLog:
    """Numbered entries, each a commit with its tables, below ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base
        self._files = Files(spark, base)

    @staticmethod
    def _name(number: int) -> str:
        return f"{number:020d}.json"

    def _read(self) -> tuple[dict | None, list[dict]]:
        """The hint, and the rows of all entries after it."""
        hint = self._files.read(_HINT)
        hint = json.loads(hint) if hint else None
        rows, number = [], hint["number"] + 1 if hint else 1
        while (entry := self._files.read(self._name(number))) is not None:
            rows += [json.loads(line) for line in entry.splitlines()]
            number += 1
        return hint, rows

    def _frame(self, hint: dict | None, rows: list[dict]) -> DataFrame:
        schema = T._parse_datatype_string(_COMMITS)
        times = {f.name for f in schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
        values = [tuple(datetime.fromisoformat(r[n]) if n in times else r[n] for n in schema.names) for r in rows]
        recent = self.spark.createDataFrame(values, schema)
        if hint is None:
            return recent
        return self.spark.read.schema(schema).parquet(f"{self.base}/{hint['folder']}").unionByName(recent)

    def commits(self) -> DataFrame:
        """The tables of every commit; of a batch committed several times at least the last."""
        return self._frame(*self._read())

    def append(self, rows: list[dict]) -> None:
        """Add a commit of these tables."""
        while True:
            hint, recent = self._read()
            number = max([r["number"] for r in recent], default=hint["number"] if hint else 0) + 1
            numbered = [{"number": number, **row} for row in rows]
            if self._files.create(self._name(number), "\n".join(json.dumps(row) for row in numbered)):
                break
        since = number - (hint["number"] if hint else 0)
        if since >= COMPACT_EVERY:
            self._compact(self._frame(hint, recent + numbered), number)

    def _compact(self, commits: DataFrame, number: int) -> None:
        """Write the last commit of every batch as one table, then point to it."""
        folder = f"upto={number}-{uuid.uuid4().hex[:12]}"
        newest(commits).coalesce(1).write.mode("errorifexists").parquet(f"{self.base}/{folder}")
        self._files.replace(_HINT, json.dumps({"number": number, "folder": folder}))


def newest(commits: DataFrame) -> DataFrame:
    """The rows of each batch's last commit."""
    last = F.max("number").over(Window.partitionBy("batch_id"))
    return commits.withColumn("_last", last).where("number = _last").drop("_last")


class Layer:
    """One layer of the lakehouse under ``<root>/<name>``."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.name = spark, name
        self._base = f"{root.rstrip('/')}/{name}"

    @cached_property
    def _log(self) -> CommitLog:
        return CommitLog(self.spark, f"{self._base}/_commits")

    def begin(self, batch: Batch, replace_committed: bool = True) -> Batch:
        """A new attempt at the batch. A committed batch is an error if it may not be replaced."""
        if not replace_committed and not self.manifest(batch).isEmpty():
            raise FileExistsError(f"{self.name} batch {batch.batch_id} is already committed.")
        return replace(batch, attempt=f"{self.name}-{uuid.uuid4().hex[:12]}")

    def _attempt(self, batch: Batch) -> str:
        """The attempt that ``batch`` holds for this layer, else the committed one."""
        if batch.attempt and batch.attempt.startswith(f"{self.name}-"):
            return batch.attempt
        return self.committed(batch).attempt

    def committed(self, batch: Batch) -> Batch:
        """The batch with the attempt that this layer committed last."""
        found = self.manifest(batch).select("attempt").first()
        if found is None:
            raise FileNotFoundError(f"{self.name} batch {batch.batch_id} is not committed.")
        return replace(batch, attempt=found["attempt"])

    def path(self, table: str, batch: Batch) -> str:
        folder = f"ingestion_date={batch.ingestion_date}/batch_id={batch.batch_id}/attempt={self._attempt(batch)}"
        return f"{self._base}/{table}/{folder}"

    def _entry(self, batch: Batch, attempt: str, table: str = "") -> str:
        below = f"/table={table}" if table else ""
        return f"{self._base}/_writes/batch={batch.batch_id}/attempt={attempt}{below}"

    def write(
        self, df: DataFrame, table: str, batch: Batch, split_by: str | None = None, rows_where: str = "true", required: Sequence[str] = ()
    ) -> Written:
        """Write one table of an attempt that was begun.

        Rows that meet ``rows_where``, and among them those without a value in each ``required`` column, are counted by the write itself.
        """
        path = self.path(table, batch)
        counted = Observation()
        meets = F.expr(rows_where)
        empty: list[Column] = [F.count_if(meets & F.col(c).isNull()).alias(f"nulls_{i}") for i, c in enumerate(required)]
        writer = df.observe(counted, F.count_if(meets).alias("row_count"), *empty).write.mode("errorifexists")
        (writer.partitionBy(split_by) if split_by else writer).parquet(path)
        found = counted.get
        nulls = {c: found.get(f"nulls_{i}") or 0 for i, c in enumerate(required)}
        written = Written(found.get("row_count") or 0, nulls, df.schema)
        entry = self.spark.createDataFrame([(table, written.row_count, nulls, df.schema.json())], _WRITES).coalesce(1)
        entry.write.mode("errorifexists").parquet(self._entry(batch, self._attempt(batch), table))
        logger.info("%s.%s written, batch %s, %d rows", self.name, table, batch.batch_id, written.row_count)
        return written

    def written(self, table: str, batch: Batch) -> Written:
        """What the log keeps about a table of a batch."""
        found = self._entries(self._entry(batch, self._attempt(batch), table)).first()
        if found is None:
            raise FileNotFoundError(f"{self.name}.{table} has no batch {batch.batch_id}")
        return Written(found["row_count"], found["null_counts"], T.StructType.fromJson(json.loads(found["columns"])))

    def read(self, table: str, batch: Batch) -> DataFrame:
        """Read one table of a batch with the columns it was written with: of the attempt at hand, else the committed one."""
        batch = replace(batch, attempt=self._attempt(batch))
        return self.spark.read.schema(self.written(table, batch).schema).parquet(self.path(table, batch))

    def commit(self, batch: Batch, tables=TABLES) -> Batch:
        """Let the attempt stand for the batch, after checking that all ``tables`` were written. The entry is the last thing written."""
        attempt = self._attempt(batch)
        written = {r["table_name"]: r["row_count"] for r in self._entries(self._entry(batch, attempt)).collect()}
        absent = sorted(set(tables) - set(written))
        if absent:
            raise RuntimeError(f"{self.name} batch {batch.batch_id} is incomplete, no {', '.join(absent)}")
        common = {
            "batch_id": batch.batch_id, "ingestion_date": batch.ingestion_date, "ingestion_ts": batch.ingested_at.isoformat(),
            "attempt": attempt, "committed_at": utc_now().isoformat(),
        }
        self._log.append([{**common, "table_name": t, "row_count": n} for t, n in sorted(written.items())])
        return replace(batch, attempt=attempt)

    def manifest(self, batch: Batch | None = None) -> DataFrame:
        """One row per table of the attempt committed last, of one batch or of all."""
        commits = self._log.commits()
        if batch:
            commits = commits.where(F.col("batch_id") == batch.batch_id)
        return newest(commits).drop("number").withColumn("committed", F.lit(True))

    def _newest(self, time: str) -> Batch | None:
        """The complete committed batch that is newest by ``time``."""
        manifest = self.manifest()
        attempts = manifest.select("batch_id", "attempt").distinct()
        ready = complete_batches(manifest).where("committed").join(attempts, "batch_id")
        found = ready.agg(F.max_by(F.struct("batch_id", "ingestion_ts", "attempt"), F.struct(time, "batch_id")).alias("found")).first()["found"]
        return found and Batch(found["batch_id"], found["ingestion_ts"], found["attempt"])

    def latest_committed(self) -> Batch:
        """The committed batch with all tables that has the newest ingestion time."""
        found = self._newest("ingestion_ts")
        if found is None:
            raise RuntimeError(f"No complete batch in layer {self.name}.")
        return found

    def last_committed(self) -> Batch:
        """The committed batch that was committed last."""
        found = self._newest("committed_at")
        if found is None:
            raise FileNotFoundError(f"No committed batch in layer {self.name}.")
        return found

    def check(self, batch: Batch, tables=TABLES) -> list[str]:
        """Fail unless the batch is committed with all ``tables``; return the names of empty ones."""
        counts = {r["table_name"]: r["row_count"] for r in self.manifest(batch).collect()}
        if not counts:
            raise FileNotFoundError(f"{self.name} batch {batch.batch_id} is not committed.")
        absent = sorted(set(tables) - set(counts))
        if absent:
            raise ValueError(f"{self.name} batch {batch.batch_id} lacks table(s): {', '.join(absent)}")
        empty = [t for t in tables if counts[t] == 0]
        if empty:
            logger.warning("%s batch %s has empty table(s): %s", self.name, batch.batch_id, ", ".join(empty))
        return empty

    def _entries(self, entry: str) -> DataFrame:
        reader = self.spark.read.schema(_WRITES).option("recursiveFileLookup", "true")
        try:
            return reader.parquet(entry)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], _WRITES)
