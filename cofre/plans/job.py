"""The job: stages from source to reports, each reading what the one before has committed."""

from __future__ import annotations

import argparse
import logging
import os
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cofre.operators.keysets import kept
from cofre.plans import checks, gold, reports, silver
from cofre.plans.star import Star, staging
from cofre.schemas import ROW_SEQ, TABLES, contract
from cofre.sources.batches import Batch, Layer, utc_now
from cofre.sources.extract import JdbcSource, ParquetSource, add_audit_columns, check_complete, extract_all, utc_literal
from cofre.sources.serving import JdbcTarget, publish_jdbc, publish_snapshot

logger = logging.getLogger(__name__)

STAGES = ("bronze", "silver", "gold", "star", "reports", "serving", "full")
OUTCOME, VALID, REJECTED = "outcome", "valid", "rejected"


@dataclass
class Job:
    """A lakehouse under ``root`` fed by ``source``."""

    spark: SparkSession
    root: str
    source: object = None
    database: str = "silver"
    target: JdbcTarget | None = None

    def layer(self, name: str) -> Layer:
        return Layer(self.spark, self.root, name)

    def bronze(self, batch_id: str | None = None, ingested_at: datetime | None = None) -> Batch:
        """Snapshot all source tables. ``_row_seq`` fixes the input order once and for all."""
        extracted = extract_all(self.spark, self.source)
        check_complete(extracted)
        layer = self.layer("bronze")
        batch = layer.begin(Batch(batch_id or str(uuid.uuid4()), ingested_at or utc_now()), replace_committed=False)
        for table in TABLES:
            numbered = extracted[table].withColumn(ROW_SEQ, F.monotonically_increasing_id())
            audited = add_audit_columns(numbered, batch.batch_id, batch.ingested_at)
            layer.write(audited, table, batch)
        return layer.commit(batch)

    def silver(self) -> Batch:
        """Clean the newest bronze batch. Each table is one write, split into valid and rejected rows."""
        source, target = self.layer("bronze"), self.layer("silver")
        newest = source.latest_committed()
        batch = target.begin(newest)
        prepared = {t: silver.prepare(source.read(t, newest), t) for t in TABLES}
        repeated = silver.settle_repeated(prepared)
        rows: dict[str, DataFrame] = {}
        for table in TABLES:
            parents = {r.parent: rows[r.parent] for r in contract(table).references}
            tagged = silver.TAGGERS[table](prepared[table], repeated[table], parents)
            tagged = tagged.withColumns({
                OUTCOME: F.when(F.col("_reject_reason").isNull(), VALID).otherwise(REJECTED),
                "_rejected_at": F.when(F.col("_reject_reason").isNotNull(), utc_literal(utc_now())),
            })
            target.write(
                tagged, table, batch, split_by=OUTCOME, rows_where=f"{OUTCOME} = '{VALID}'", required=checks.NOT_NULL[f"stg_{table}"]
            )
            rows[table] = self.trusted(table, batch)
        return target.commit(batch)

    def tagged(self, table: str, batch: Batch) -> DataFrame:
        """What the silver stage wrote for a table, valid and rejected rows."""
        contract(table)
        return self.layer("silver").read(table, batch)

    def trusted(self, table: str, batch: Batch) -> DataFrame:
        """Valid rows of a table; only their folder is read."""
        tagged = self.tagged(table, batch)
        return silver.trusted_rows(tagged.where(F.col(OUTCOME) == VALID), table)

    def rejects(self, table: str, batch: Batch) -> DataFrame:
        """Quarantined rows of a table with reason and time; only their folder is read."""
        tagged = self.tagged(table, batch)
        return silver.reject_rows(tagged.where(F.col(OUTCOME) == REJECTED)).drop(OUTCOME)

    def _trusted_batch(self) -> tuple[Batch, dict[str, DataFrame]]:
        layer = self.layer("silver")
        batch = layer.last_committed()
        layer.check(batch)
        return batch, {t: self.trusted(t, batch) for t in TABLES}

    def _write_all(self, layer_name: str, frames: dict[str, DataFrame], batch: Batch) -> None:
        layer = self.layer(layer_name)
        batch = layer.begin(batch)
        for name, frame in frames.items():
            layer.write(frame, name, batch)
        layer.commit(batch, tuple(frames))

    def gold(self) -> Batch:
        """Write the analytical datasets of the newest silver batch."""
        batch, trusted = self._trusted_batch()
        self._write_all("gold", gold.build_all(trusted), batch)
        return batch

    def star(self) -> Batch:
        """Write dimensions, then facts that read the written dimensions, then the check results.

        Required columns were counted by the writes of both layers, so that contract reads no rows.
        """
        source, trusted = self._trusted_batch()
        staged = {t: staging(df, t) for t, df in trusted.items()}
        layer = self.layer("star")
        batch = layer.begin(source)
        nulls = {f"stg_{t}": self.layer("silver").written(t, source).null_counts for t in TABLES}

        def write(name: str, frame: DataFrame) -> DataFrame:
            nulls[name] = layer.write(frame, name, batch, required=checks.NOT_NULL[name]).null_counts
            return layer.read(name, batch)

        star = Star(staged)
        dims = {name: write(name, frame) for name, frame in star.dimensions().items()}
        # Facts read the written dimensions; the few types may as well be numbered again.
        star.cliente, star.conta = dims["dim_cliente"], dims["dim_conta"]
        star.data = dims["dim_data"]
        facts = {"fato_transacao": write("fato_transacao", star.transactions()), "fato_emprestimo": write("fato_emprestimo", star.loans())}
        models = dims | facts | {f"stg_{t}": df for t, df in staged.items()}
        layer.write(checks.all_checks(models, nulls), "contract_results", batch)
        failed = layer.read("contract_results", batch).where("violations > 0").collect()
        if failed:
            raise ValueError("Data contracts broken: " + "; ".join(f"{r.model}.{r.column} {r.check}" for r in failed))
        layer.commit(batch, (*dims, *facts, "contract_results"))
        return source

    def reports(self) -> dict[str, DataFrame]:
        """Write the reports over the star of the newest silver batch. Each fact is read once, for its summary."""
        batch, _ = self._trusted_batch()
        layer = self.layer("star")
        batch = layer.committed(batch)
        tables = ("dim_cliente", "dim_conta", "dim_tipo_transacao", "dim_data", "fato_transacao", "fato_emprestimo")
        layer.check(batch, tables)
        star = {t: layer.read(t, batch) for t in tables}
        moves = kept(reports.transaction_summary(star["fato_transacao"]))
        credits = kept(reports.loan_summary(star["fato_emprestimo"]))
        built = reports.build_all(moves, credits, star)
        self._write_all("reports", built, batch)
        return built

    def serving(self) -> Batch:
        """Publish the newest silver batch under catalog names, and to the target database if there is one."""
        batch, trusted = self._trusted_batch()
        publish_snapshot(self.spark, trusted, batch.batch_id, self.database, f"{self.root.rstrip('/')}/serving")
        if self.target:
            publish_jdbc(trusted, self.target)
        return batch

    def run_stage(self, stage: str) -> None:
        """Run one stage, or all of them in order."""
        if stage not in STAGES:
            raise ValueError(f"Unknown stage {stage!r}, expected one of: {', '.join(STAGES)}.")
        for name in STAGES[:-1] if stage == "full" else (stage,):
            logger.info("Stage %s", name)
            getattr(self, name)()


def read_properties(path: str | None) -> dict[str, str]:
    """Connection properties (user, password, driver, ...) of a file with a name=value per line, # for comments.

    COFRE_JDBC_USER and COFRE_JDBC_PASSWORD in the environment come on top.
    """
    found = {}
    if path:
        with open(path, encoding="utf-8") as lines:
            pairs = [line.strip() for line in lines if line.strip() and not line.lstrip().startswith("#")]
        for pair in pairs:
            name, sign, value = pair.partition("=")
            if not sign:
                raise ValueError(f"Not a name=value line in {path}: {name}")
            found[name.strip()] = value.strip()
    for name in ("user", "password"):
        if value := os.environ.get(f"COFRE_JDBC_{name.upper()}"):
            found[name] = value
    return found


def connections(given: argparse.Namespace) -> tuple[object, JdbcTarget | None]:
    """Source and target database of the command line; None where there is none."""
    source, target = None, None
    if given.source and given.source.startswith("jdbc:"):
        properties = read_properties(given.source_properties)
        source = JdbcSource(given.source, properties, given.fetch_size, given.jdbc_partitions)
    elif given.source:
        source = ParquetSource(given.source)
    if given.publish:
        properties = read_properties(given.publish_properties or given.source_properties)
        target = JdbcTarget(given.publish, properties, given.publish_schema, given.batch_size, given.jdbc_partitions)
    return source, target


def parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Run the lakehouse job.")
    parser.add_argument("--stage", required=True, choices=STAGES)
    parser.add_argument("--root", required=True, help="shared folder of the lakehouse")
    parser.add_argument("--source", help="jdbc: URL, or folder with one Parquet file per table")
    parser.add_argument("--source-properties", help="file of name=value lines for the source connection")
    parser.add_argument("--fetch-size", type=int, default=1000, help="rows per round trip from the source")
    parser.add_argument("--jdbc-partitions", type=int, default=8, help="parallel connections per table")
    parser.add_argument("--publish", help="jdbc: URL that the serving stage also fills")
    parser.add_argument("--publish-properties", help="file of name=value lines, else that of the source")
    parser.add_argument("--publish-schema", default="silver", help="schema of the published tables")
    parser.add_argument("--batch-size", type=int, default=1000, help="rows per insert")
    parser.add_argument(
        "--shuffle-partitions", help="starting number per shuffle, merged at run time; about shuffled bytes / 128 MB"
    )
    return parser


def main(arguments: list[str] | None = None) -> int:
    """Command line for spark-submit; returns 1 when the stage fails."""
    from cofre.session import build_session

    given = parser().parse_args(arguments)
    settings = {"spark.sql.shuffle.partitions": given.shuffle_partitions} if given.shuffle_partitions else {}
    try:
        source, target = connections(given)
        Job(build_session("cofre", **settings), given.root, source, target=target).run_stage(given.stage)
    except Exception:
        logger.exception("Stage %s failed", given.stage)
        return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
