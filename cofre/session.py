"""Spark session with the settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: small shuffle partitions are merged, skewed ones split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split write keeps one file open per part instead of sorting the rows by part first.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with :data:`SETTINGS`; ``settings`` come on top."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
