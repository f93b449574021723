"""Extraction of the source tables, from a database over JDBC or from Parquet files."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cofre.schemas import SOURCE_SYSTEM, TABLES, contract, require_columns


@dataclass(frozen=True)
class ParquetSource:
    """Source tables as ``<folder>/<table>.parquet``."""

    folder: str

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(f"{self.folder}/{table}.parquet")


@dataclass(frozen=True)
class JdbcSource:
    """Source tables of a database, each read in ranges of its primary key by parallel connections."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    fetch_size: int = 1000
    partitions: int = 8

    def __post_init__(self):
        if self.fetch_size <= 0:
            raise ValueError("fetch_size must be greater than zero.")
        if self.partitions <= 0:
            raise ValueError("partitions must be greater than zero.")

    def options(self, table: str, low: int | None, high: int | None) -> dict[str, str]:
        """Reader options; without bounds (empty table) the read is one range."""
        chosen = {"url": self.url, "dbtable": table, "fetchsize": str(self.fetch_size), **self.properties}
        if low is not None:
            chosen |= {
                "partitionColumn": contract(table).key,
                "lowerBound": str(low),
                "upperBound": str(high),
                "numPartitions": str(self.partitions),
            }
        return chosen

    def load(self, spark: SparkSession, table: str) -> DataFrame:
        key = contract(table).key
        bounds = spark.read.format("jdbc").options(
            url=self.url, query=f"select min({key}) as low, max({key}) as high from {table}", **self.properties
        )
        low, high = bounds.load().first()
        return spark.read.format("jdbc").options(**self.options(table, low, high)).load()


def extract_table(spark: SparkSession, source, table: str) -> DataFrame:
    """Full scan of one source table, reduced to its contract columns."""
    columns = contract(table).source_columns
    return require_columns(source.load(spark, table), table).select(*columns)


def extract_all(spark: SparkSession, source) -> dict[str, DataFrame]:
    """All source tables, as lazy scans."""
    return {table: extract_table(spark, source, table) for table in TABLES}


def check_complete(extracted: dict[str, DataFrame]) -> None:
    """Fail when a table is absent or is no DataFrame; runs no job."""
    absent = [t for t in TABLES if t not in extracted]
    if absent:
        raise ValueError(f"Extraction lacks table(s): {', '.join(absent)}")
    wrong = [t for t in TABLES if not isinstance(extracted[t], DataFrame)]
    if wrong:
        raise TypeError(f"Extraction returned no DataFrame for table(s): {', '.join(wrong)}")


def utc_literal(moment: datetime) -> Column:
    """A UTC time without zone as a column, independent of the session zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def add_audit_columns(df: DataFrame, batch_id: str, ingested_at: datetime) -> DataFrame:
    """Add source system, ingestion time (UTC) and batch id, the same in every row of a batch."""
    return df.withColumns({
        "_source_system": F.lit(SOURCE_SYSTEM),
        "_ingestion_timestamp": utc_literal(ingested_at),
        "_batch_id": F.lit(batch_id),
    })
