"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The expansions multiply what a shuffle delivers, so small shuffle partitions stay apart.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "128k",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Apply the settings to a session builder."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
