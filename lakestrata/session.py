"""Session settings the library is written for.

Storage credentials never appear here: they come from the Spark configuration
or the environment of the cluster.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

# Left joins against dimensions carry hot and null keys.  Adaptive execution
# splits those partitions; `forceOptimizeSkewedJoin` lets it do so even where
# the split costs one more exchange downstream.
SETTINGS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    # Parquet grows several times in memory: compare the broadcast threshold
    # with that size, not with the size of the compressed files.
    "spark.sql.sources.fileCompressionFactor": "4.0",
}

# Known before the session starts: tables that are built at the same time share the executors.
START_SETTINGS: dict[str, str] = {"spark.scheduler.mode": "FAIR"}


def build_session(app: str = "lakestrata", conf: Mapping[str, str] | None = None) -> SparkSession:
    """Session with the library's settings; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SETTINGS, **START_SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the library's settings on a session somebody else started."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
