"""A folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; where that is unset and Spark runs on one machine, a temporary one."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext._jsc.sc().isLocal():
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        top = tempfile.mkdtemp(prefix="wayloom")
    return f"{top}/{name}-{uuid.uuid4().hex[:12]}"


def optional(read, spark: SparkSession, path: str) -> DataFrame | None:
    """What a reader finds at a path; None if there is nothing, as before the first run."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return read(spark, path) if there else None
