"""Session settings the library is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Shuffle partition counts, memory and the master belong to the deployment and
# are left alone; AQE resizes partitions at run time.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Bucketed state tables have one sorted file per bucket; a merge need not sort them again.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


def build_session(app_name: str = "tidemark", conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RECOMMENDED_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
