"""Session settings the library relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

REQUIRED = {
    # Text timestamps carry no zone; a fixed session zone keeps every cast stable.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # What a task takes in, so that it sorts and groups that in memory: key columns compress to a
    # tenth of their size in memory or less, and at Spark's 128m and 64m a task would need gigabytes.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def build_session(name: str = "stayflow", **conf: str) -> SparkSession:
    """A session with the required settings; master and memory come from the caller
    (``conf`` or spark-submit). Extra settings use their full Spark names."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require(spark: SparkSession) -> SparkSession:
    """Apply the required settings to a session made elsewhere."""
    for key, value in REQUIRED.items():
        # No default here: Spark would convert it to the setting's own type.
        if spark.conf.get(key).lower() != value.lower():
            spark.conf.set(key, value)
    return spark
