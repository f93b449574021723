"""Serving tables: the trusted snapshot under catalog names that reports and tools query.

Each serving name is a view over a table partitioned by version. All views take the version from one table, to which a publish appends a
single row after everything else is in place: that one write moves all names at once, and nobody sees tables of two versions.
"""

from __future__ import annotations

import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cofre.schemas import AUDIT_COLUMNS, TABLES, contract, require_columns

logger = logging.getLogger(__name__)

_AUDIT_TYPES = dict(zip(AUDIT_COLUMNS, (T.StringType(), T.TimestampType(), T.StringType())))


def serving_schema(table: str) -> T.StructType:
    """Columns of a serving table in order. Times are instants here, as other tools expect them."""
    zoned = [(name, T.TimestampType() if isinstance(kind, T.TimestampNTZType) else kind)
             for name, kind in contract(table).trusted]
    return T.StructType([T.StructField(n, t) for n, t in [*zoned, *_AUDIT_TYPES.items()]])


#: The table that names the published versions, newest last.
PUBLISHED = "published_versions"
VERSION = "version"


def _versions(table: str) -> str:
    return f"{table}_versions"


def create_serving_tables(spark: SparkSession, database: str, root: str) -> None:
    """Create database, versioned tables and the views over them that are not there yet; nothing is published at first."""
    root = root.rstrip("/")
    spark.sql(f"create database if not exists {database}")
    spark.sql(
        f"create table if not exists {database}.{PUBLISHED} (number bigint, {VERSION} string) using parquet location '{root}/{PUBLISHED}'"
    )
    current = f"select max_by({VERSION}, struct(number, {VERSION})) from {database}.{PUBLISHED}"
    for table in TABLES:
        schema = serving_schema(table)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"create table if not exists {database}.{_versions(table)} ({columns}, {VERSION} string) "
            f"using parquet partitioned by ({VERSION}) location '{root}/{table}'"
        )
        names = ", ".join(f"`{f.name}`" for f in schema)
        spark.sql(
            f"create view if not exists {database}.{table} as "
            f"select {names} from {database}.{_versions(table)} where {VERSION} = ({current})"
        )


def _as_served(df: DataFrame, table: str) -> DataFrame:
    """Trusted rows in serving order and types. Times hold UTC, so they are read as UTC."""
    schema = serving_schema(table)
    require_columns(df, table, [f.name for f in schema])
    kinds = {f.name: f.dataType for f in df.schema}
    columns = []
    for field in schema:
        if isinstance(field.dataType, T.TimestampType) and isinstance(kinds[field.name], T.TimestampNTZType):
            text = f"cast(convert_timezone('UTC', current_timezone(), `{field.name}`) as timestamp)"
        else:
            text = f"cast(`{field.name}` as {field.dataType.simpleString()})"
        columns.append(f"{text} as `{field.name}`")
    return df.selectExpr(*columns)


def _checked(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    absent = [t for t in TABLES if t not in tables]
    if absent:
        raise FileNotFoundError(f"Snapshot lacks table(s): {', '.join(absent)}")
    return {t: _as_served(tables[t], t) for t in TABLES}


def publish_snapshot(spark: SparkSession, tables: dict[str, DataFrame], version: str, database: str, root: str) -> None:
    """Replace the content of all serving tables by one snapshot.

    Every table is checked, and written as a new version that no view names yet, also when ``version`` was published
    before. Then one row names it. A failure at any point before leaves all tables as they were.
    """
    served = _checked(tables)
    create_serving_tables(spark, database, root)
    attempt = f"{version}-{uuid.uuid4().hex[:12]}"
    for table, frame in served.items():
        folder = f"{root.rstrip('/')}/{table}/{VERSION}={attempt}"
        frame.write.mode("errorifexists").parquet(folder)
        spark.sql(f"alter table {database}.{_versions(table)} add partition ({VERSION} = '{attempt}') location '{folder}'")
    _point_to(spark, attempt, database)


def _point_to(spark: SparkSession, version: str, database: str) -> None:
    """Append the row that makes ``version`` the current one. It is one file, so it is there or not."""
    name = f"{database}.{PUBLISHED}"
    spark.catalog.refreshTable(name)
    following = spark.table(name).agg((F.coalesce(F.max("number"), F.lit(0)) + 1).alias("number"))
    following.select("number", F.lit(version).alias(VERSION)).coalesce(1).write.insertInto(name)
    spark.catalog.refreshTable(name)


@dataclass(frozen=True)
class JdbcTarget:
    """A database whose tables receive the snapshot."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    schema: str = "silver"
    batch_size: int = 1000
    partitions: int = 8

    def __post_init__(self):
        if self.batch_size <= 0:
            raise ValueError("batch_size must be greater than zero.")
        if self.partitions <= 0:
            raise ValueError("partitions must be greater than zero.")

    def staging(self, table: str) -> str:
        """Where a table's rows are loaded before they count."""
        return f"{self.schema}.{table}_staging"

    def options(self, table: str) -> dict[str, str]:
        """Writer options of the staging table: truncate and refill in batches of inserts, over a bounded number of connections."""
        return {
            "url": self.url,
            "dbtable": self.staging(table),
            "truncate": "true",
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.partitions),
            **self.properties,
        }

    def switch_statements(self) -> list[str]:
        """Replace the rows of all tables by those of the staging tables: children are emptied first, parents filled first."""
        fills = []
        for table in TABLES:
            names = ", ".join(f.name for f in serving_schema(table))
            fills.append(f"insert into {self.schema}.{table} ({names}) select {names} from {self.staging(table)}")
        return [f"delete from {self.schema}.{table}" for table in reversed(TABLES)] + fills


def run_in_transaction(connection, statements: list[str]) -> None:
    """Run all statements on a JDBC connection as one transaction, or none of them."""
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for text in statements:
            statement.execute(text)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _connect(spark: SparkSession, target: JdbcTarget):
    jvm = spark.sparkContext._jvm
    properties = jvm.java.util.Properties()
    for name, value in target.properties.items():
        properties.setProperty(name, value)
    if "driver" in target.properties:
        jvm.java.lang.Class.forName(target.properties["driver"], True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    return jvm.java.sql.DriverManager.getConnection(target.url, properties)


def publish_jdbc(tables: dict[str, DataFrame], target: JdbcTarget) -> None:
    """Replace the serving tables of a database.

    Each table is checked before the first is touched and loaded into a staging table, over several connections. One transaction
    then replaces the rows of all serving tables, so readers see the old or the new snapshot.
    """
    served = _checked(tables)
    for table, frame in served.items():
        frame.write.format("jdbc").options(**target.options(table)).mode("overwrite").save()
    run_in_transaction(_connect(frame.sparkSession, target), target.switch_statements())
