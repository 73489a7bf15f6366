"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_cleared: set[str] = set()


def shared_folder(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``; it is deleted when the driver's JVM ends.

    Where the setting is missing, a local session, as in tests, takes a temporary folder; a cluster's executors
    wouldn't share one, so there it is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not base:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "corpusloom-checkpoints")
    folder = f"{base.rstrip('/')}/corpusloom-{context.applicationId}"
    if folder not in _cleared:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _cleared.add(folder)
    return folder


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
