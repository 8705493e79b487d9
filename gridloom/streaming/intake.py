"""New files only, as a stream: the checkpoint is the ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.sources.files import scanned_path
from gridloom.sources.workbook import SIZE_LIMIT, WORKBOOK_GLOB, grid_of


def csv_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV files as they arrive, in folders below as well; malformed rows keep their text in ``_corrupt_record``."""
    return (
        spark.readStream.schema(f"{schema}, _corrupt_record string")
        .option("recursiveFileLookup", True)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .csv(path)
        .withColumn("source_file", scanned_path())
    )


def grid_stream(spark: SparkSession, path: str, all_sheets: bool = False, size_limit: int = SIZE_LIMIT) -> DataFrame:
    """Workbooks as they arrive, in folders below as well, as a cell grid; trouble shows up as rows with ``error`` set."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", WORKBOOK_GLOB)
        .option("recursiveFileLookup", True)
        .load(path)
    )
    return grid_of(files, all_sheets, size_limit)


def split_sink(target: str, quarantine: str) -> Callable[[DataFrame, int], None]:
    """Batch writer: good rows to one table, malformed rows with a reason to another.

    Each batch overwrites its own folder, so a repeated batch leaves no duplicates.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        good = batch.filter("_corrupt_record is null").drop("_corrupt_record")
        bad = batch.filter("_corrupt_record is not null").select(
            "source_file", F.col("_corrupt_record").alias("record"), F.lit("malformed record").alias("reason")
        )
        good.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        bad.write.mode("overwrite").parquet(f"{quarantine}/batch={batch_id}")

    return write


def run_available(stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process everything that is new, then stop."""
    query = (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(sink)
        .start()
    )
    query.awaitTermination()
    return query
