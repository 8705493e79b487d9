"""Tables and files that several later steps read, kept in the shared folder of the session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Ids up to which a list of rows to leave out is broadcast; 8 bytes each.
FEW = 1_000_000


def shared_folder(spark: SparkSession) -> str:
    """A new folder name below ``spark.checkpoint.dir``; the warehouse stands in where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def staged(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows of ``df`` as a Parquet table that every executor can read again."""
    spark = df.sparkSession
    path = folder or shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mounted(path: str) -> str:
    """A shared folder as a path for plain file calls, which memory mapping needs."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"{path} is not a mounted folder")
    return path


def without(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose key is not in ``ids`` (one column of that name); rows with a null key stay."""
    ids = staged(ids.distinct())
    return df.join(F.broadcast(ids) if ids.count() <= FEW else ids, key, "left_anti")
