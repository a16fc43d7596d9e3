"""Intermediate results that are used more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
_own: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def _root(spark: SparkSession) -> str:
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
    return _own.setdefault(context.applicationId, tempfile.mkdtemp(prefix="run-"))


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below the shared one the session names in ``spark.checkpoint.dir``.

    A session of one machine (``local[n]``) without that setting gets a local folder; on a cluster
    a missing setting raises.
    """
    path = f"{_root(spark)}/stallwise-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def materialized(d: DataFrame) -> DataFrame:
    """Write a DataFrame to the shared folder and read it back.

    This cuts the lineage, lets several readers share the work and survives lost executors;
    the plan that goes on from here also knows the true size.
    """
    path = scratch_dir(d.sparkSession)
    d.write.option("compression", "zstd").parquet(path)
    return d.sparkSession.read.schema(d.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Remove what this session has materialized, once its results are written; returns the folders removed.

    DataFrames that still read those folders fail afterwards.
    """
    folders = _made.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(folders)
