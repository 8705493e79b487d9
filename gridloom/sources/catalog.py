"""Column catalog (file, ordinal, column, type) of a folder of mixed files, worked out in tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.sources.csv_scan import INFERRED, csv_headers, data_lines, fields_of, fitting, header_names
from gridloom.sources.files import glob_of, list_files, opened, scanned_path
from gridloom.sources.folder import FORMATS, file_catalog
from gridloom.sources.workbook import WORKBOOK_GLOB, grid_rows, read_grid

CATALOG_SCHEMA = "file string, ordinal int, column string, type string"


def csv_catalog(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """CSV columns as text, or with the narrowest type that fits all of a file's values; lines that cannot be read have
    no say in it."""
    heads = header_names(csv_headers(spark, path))
    columns = heads.select(F.col("path").alias("file"), F.posexplode("names").alias("ordinal", "column"))
    if not infer:
        return columns.withColumn("type", F.lit("string"))
    lines = fields_of(data_lines(spark, path), "value", "fields")
    cells = lines.select(F.col("path").alias("file"), F.posexplode("fields").alias("ordinal", "v")).filter("v is not null")
    fits = cells.groupBy("file", "ordinal").agg(F.bit_and(fitting(F.col("v"))).alias("bits"))
    kind = F.when(F.col("bits").bitwiseAND(F.lit(1)) > 0, INFERRED[0])
    for i, name in enumerate(INFERRED[1:], 1):
        kind = kind.when(F.col("bits").bitwiseAND(F.lit(2**i)) > 0, name)
    typed = fits.select("file", "ordinal", kind.otherwise("string").alias("type"))
    return columns.join(typed, ["file", "ordinal"], "left").na.fill("string", ["type"])


def _footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Columns from the footers of Parquet files; data pages are not read."""
    import pyarrow.parquet as pq

    for batch in batches:
        found = []
        for path in batch["path"]:
            system, inner = opened(path)
            with system.open_input_file(inner) as file:
                schema = pq.read_schema(file)
            found += [(path, i, f.name, str(f.type)) for i, f in enumerate(schema)]
        yield pd.DataFrame(found, columns=["file", "ordinal", "column", "type"])


def parquet_catalog(spark: SparkSession, path: str) -> DataFrame:
    files = list_files(spark, path, glob_of("parquet")).select("path")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(parts).mapInPandas(_footers, CATALOG_SCHEMA)


def json_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Top-level fields of JSON lines, in name order, with the type all values of a file share."""
    lines = spark.read.option("pathGlobFilter", glob_of("json")).option("recursiveFileLookup", True).text(path)
    fields = lines.select(
        scanned_path().alias("file"), F.explode(F.from_json("value", "map<string,variant>")).alias("column", "v")
    )
    typed = fields.groupBy("file", "column").agg(F.lower(F.schema_of_variant_agg("v")).alias("type"))
    names = typed.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("column", "type"))).alias("c"))
    return names.select("file", F.posexplode("c").alias("ordinal", "c")).select("file", "ordinal", "c.column", "c.type")


def workbook_catalog(spark: SparkSession, path: str) -> DataFrame:
    rows = grid_rows(read_grid(spark, path, glob=WORKBOOK_GLOB)).filter("sheet_no = 0 and row_idx = 0")
    heads = rows.select(F.col("file_path").alias("file"), F.posexplode("cells").alias("ordinal", "column"))
    return heads.filter("column is not null").withColumn("type", F.lit("string"))


def folder_catalog(spark: SparkSession, path: str, infer: bool = False) -> DataFrame:
    """Columns of every supported file of a folder; ``infer`` types CSV columns by their values."""
    found = {FORMATS.get(r["extension"]) for r in file_catalog(spark, path).select("extension").distinct().collect()}
    readers = {
        "csv": lambda: csv_catalog(spark, path, infer),
        "parquet": lambda: parquet_catalog(spark, path),
        "json": lambda: json_catalog(spark, path),
        "workbook": lambda: workbook_catalog(spark, path),
    }
    parts = [read().select("file", "ordinal", "column", "type") for kind, read in readers.items() if kind in found]
    if not parts:
        raise ValueError(f"no supported file in {path}")
    united = reduce(DataFrame.unionByName, parts)
    return united.withColumn("file", F.regexp_replace("file", "^([a-z0-9]+):/+", "$1:/"))
