"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a folder of this machine in local mode (tests), an error on a cluster."""
    key = "spark.checkpoint.dir"
    found = spark.conf.get(key, None) or spark.sparkContext.getConf().get(key)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
        spark.conf.set(key, found)
    return found.rstrip("/")


def fresh(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing uses yet."""
    return f"{folder(spark)}/series-{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """df, written once and read back: what several jobs read is computed once, and a lost executor costs none of it."""
    path = fresh(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
