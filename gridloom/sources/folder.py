"""Folders, listings and schema documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.paths import base_name, suffix
from gridloom.operators.dedup import union_by_name
from gridloom.operators.lineage import cut
from gridloom.operators.recon import megabytes
from gridloom.sources.csv_scan import csv_headers, scan_csv  # noqa: F401
from gridloom.sources.files import glob_of, list_files, scanned_path
from gridloom.sources.workbook import WORKBOOK_GLOB, grid_errors, grid_rows, grid_to_table, read_grid

FORMATS = {
    ".csv": "csv", ".parquet": "parquet", ".json": "json",
    ".xlsx": "workbook", ".xls": "workbook", ".xlsm": "workbook", ".xlsb": "workbook",
}


def file_catalog(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, name, extension, size of each file in a folder; contents are not read."""
    return list_files(spark, path, glob).select(
        "path",
        base_name(F.col("path")).alias("name"),
        suffix(F.col("path")).alias("extension"),
        F.col("length").alias("size"),
        megabytes(F.col("length")).alias("size_mb"),
    )


def with_lineage(df: DataFrame) -> DataFrame:
    """Add source path and processing time to a file-source table."""
    return df.select(
        "*", scanned_path().alias("source_file"), F.current_timestamp().alias("processed_timestamp")
    )


def read_csv(
    spark: SparkSession, paths: str | list[str], types: str = "infer", strict: bool = False, schema: str | None = None
) -> DataFrame:
    """CSV with a header. ``types="string"`` keeps text; a given schema spares the inference pass."""
    reader = spark.read.option("header", True)
    if strict:
        reader = reader.option("multiLine", False).option("escape", '"')
    if schema is not None:
        return reader.schema(schema).csv(paths)
    return reader.option("inferSchema", types == "infer").csv(paths)


def read_parquet(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(*paths)


def read_json(spark: SparkSession, paths: str | list[str], multi_line: bool = False) -> DataFrame:
    return spark.read.option("multiLine", multi_line).json(paths)


def read_folder(
    spark: SparkSession, path: str, types: str = "infer", quarantine: str | None = None, bad_lines: str = "quarantine",
    budget: int | None = None,
) -> DataFrame:
    """All supported files of a folder and the folders below it as one table, columns united by name.

    Workbooks and CSV lines that cannot be read are written with their reasons to ``quarantine``, a Parquet folder of
    file_path, record (the line) and reason; without one they are an error. ``bad_lines="skip"`` leaves such lines out.
    More malformed lines than ``budget`` are an error either way.
    """
    kinds = {
        FORMATS.get(r["extension"])
        for r in file_catalog(spark, path).filter("size > 0").select("extension").distinct().collect()
    }
    frames: list[DataFrame] = []
    aside: list[DataFrame] = []
    if "csv" in kinds:
        scan = scan_csv(spark, path, types, budget=budget)
        frames.append(scan.good)
        if bad_lines != "skip" and scan.malformed:
            aside.append(scan.bad)
            if quarantine is None:
                first = scan.bad.first()
                raise ValueError(f"{scan.malformed} malformed lines, one in {first['file_path']}: {first['reason']}")
    if "parquet" in kinds:
        frames.append(
            spark.read.option("pathGlobFilter", glob_of("parquet")).option("recursiveFileLookup", True)
            .option("mergeSchema", True).parquet(path)
        )
    if "json" in kinds:
        frames.append(spark.read.option("pathGlobFilter", glob_of("json")).option("recursiveFileLookup", True).json(path))
    if "workbook" in kinds:
        grid = cut(read_grid(spark, path, glob=WORKBOOK_GLOB))
        errors = grid_errors(grid)
        if quarantine is None and (first := errors.first()) is not None:
            raise ValueError(f"unreadable workbook {first['file_path']}: {first['reason']}")
        aside.append(errors.select("file_path", F.lit(None).cast("string").alias("record"), "reason"))
        frames.append(grid_to_table(grid_rows(grid)).drop("file_path", "row_idx"))
    if not frames:
        raise ValueError(f"no supported file in {path}")
    if quarantine is not None and aside:
        reduce(DataFrame.unionByName, aside).write.mode("overwrite").parquet(quarantine)
    return union_by_name(frames)


def list_entries(lines: DataFrame, text: str = "value", keep: list[str] = ()) -> DataFrame:
    """Entries of a list file: blank lines and comments skipped, values trimmed of blanks."""
    line = F.regexp_replace(text, r"^\s+|\s+$", "")
    return lines.select(*keep, line.alias("line")).filter((F.col("line") != "") & ~F.col("line").startswith("#"))


def read_list(spark: SparkSession, path: str) -> DataFrame:
    return list_entries(spark.read.text(path))


def split_list(entries: DataFrame, fields: list[str], separator: str = ",", keep: list[str] = ()) -> DataFrame:
    """Separated fields of list entries; ``complete`` is false where a field is missing."""
    parts = F.split("line", separator if separator != "|" else r"\|", len(fields))
    named = [F.nullif(F.trim(F.get(parts, F.lit(i))), F.lit("")).alias(n) for i, n in enumerate(fields)]
    got = entries.select(*keep, "line", *named)
    complete = F.lit(True)
    for name in fields:
        complete = complete & F.col(name).isNotNull()
    return got.withColumn("complete", complete)


def split_names(text: Column) -> Column:
    """Comma list of folders: trimmed, one outer slash stripped at each end, empties dropped."""
    parts = F.transform(
        F.split(text, ","), lambda p: F.regexp_replace(F.regexp_replace(F.trim(p), "^/", ""), "/$", "")
    )
    return F.filter(parts, lambda p: p != "")


#: Fields of a schema document and of a listing.
SCHEMA_DOCUMENT = "name string, type string, mode string"
JSON_LISTING = "name string, folder string, properties struct<contentLength:bigint>"


def read_schema_document(spark: SparkSession, path: str) -> DataFrame:
    """Column list of a JSON schema document: name, type, mode."""
    return spark.read.schema(SCHEMA_DOCUMENT).option("multiLine", True).json(path)


def read_json_listing(spark: SparkSession, path: str) -> DataFrame:
    """JSON array of objects with a nested size; an object with a ``folder`` field is a folder."""
    return listing_entries(spark.read.schema(JSON_LISTING).option("multiLine", True).json(path))


def listing_entries(raw: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Name, kind and length of the objects of a listing."""
    return raw.select(
        *keep,
        "name",
        F.when(F.col("folder").isNotNull(), "folder").otherwise("file").alias("kind"),
        F.coalesce("properties.contentLength", F.lit(0)).alias("length"),
    )


