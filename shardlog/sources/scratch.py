"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new place under spark.checkpoint.dir, or in local mode under a temporary folder where that is unset. It goes when the driver ends."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = f"file://{tempfile.mkdtemp(prefix='shardlog-')}"
        spark.conf.set("spark.checkpoint.dir", at)
    place = f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return place


def cut(df: DataFrame, name: str) -> DataFrame:
    """df written as a table and read back: later steps neither repeat its work nor carry its plan, and survive lost executors."""
    path = folder(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
