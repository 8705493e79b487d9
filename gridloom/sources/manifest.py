"""Tables that grow by runs. A run's rows and its ledger lines become visible together, by one small file.

A run writes into folders that carry its name. Only then a line with that name is added to the manifest, as a file of
its own, which a file system does as a whole or not at all. Readers take the runs that the manifest names; what a run
left behind that broke off before is never read, so repeating it counts nothing twice.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

LEDGER_SCHEMA = "path string, status string, reason string, processed_at timestamp"


def runs(spark: SparkSession, target: str) -> DataFrame:
    """Names and times of the runs that were committed."""
    try:
        return spark.read.schema("run string, committed_at timestamp").json(f"{target}/manifest").filter("run is not null")
    except AnalysisException:
        return spark.createDataFrame([], "run string, committed_at timestamp")


def _of_runs(spark: SparkSession, target: str, part: str, schema: str) -> DataFrame:
    """Rows of one part of all committed runs; folders of other runs are pruned by the join with the manifest."""
    try:
        rows = spark.read.schema(f"{schema}, run string").option("basePath", f"{target}/{part}").parquet(f"{target}/{part}")
    except AnalysisException:
        return spark.createDataFrame([], schema)
    return rows.join(runs(spark, target).select("run"), "run", "left_semi").drop("run")


def read_table(spark: SparkSession, target: str, schema: str) -> DataFrame:
    return _of_runs(spark, target, "data", schema)


def read_ledger(spark: SparkSession, target: str) -> DataFrame:
    return _of_runs(spark, target, "ledger", LEDGER_SCHEMA)


def commit_run(spark: SparkSession, target: str, data: DataFrame, outcomes: DataFrame) -> str:
    """Write the rows and the outcomes (path, status, reason) of a run and commit both; returns the run's name."""
    run = uuid.uuid4().hex
    data.write.parquet(f"{target}/data/run={run}")
    outcomes.select("path", "status", "reason", F.current_timestamp().alias("processed_at")).write.parquet(f"{target}/ledger/run={run}")
    publish(spark, target, run)
    return run


def publish(spark: SparkSession, target: str, run: str) -> None:
    line = spark.range(1).select(F.lit(run).alias("run"), F.current_timestamp().alias("committed_at"))
    line.coalesce(1).write.mode("append").json(f"{target}/manifest")
