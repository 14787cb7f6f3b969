"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; only a session on one machine may do without."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (named or "file:///tmp/checkpoints").rstrip("/")


def scratch_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/jobtide-core/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The table written to the shared folder and read back; loops end their lineage so."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
