"""Cutting a plan where several later steps would otherwise recompute it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession) -> str:
    """A new folder name in the shared folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_cut"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write rows as a Parquet table to the shared folder and go on from there.

    The folder is ``spark.checkpoint.dir``; where that is unset, one below the warehouse. Every executor reaches
    either, so a lost executor costs no recompute, and later reads prune columns.
    """
    spark = df.sparkSession
    path = shared_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
