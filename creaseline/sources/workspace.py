"""Scratch tables in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; without one, a folder in the session's warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path for one scratch table, removed when the session's JVM ends."""
    path = f"{shared_folder(spark)}/creaseline-{name}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def settled(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table to the shared folder and read it back.

    Its lineage ends there, and the planner knows its size from the files.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
