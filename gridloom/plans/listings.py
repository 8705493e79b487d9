"""Jobs over file listings: reconciliation, size report, schema grouping, load planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.names import normalise_typography
from gridloom.functions.paths import (
    base_name,
    directory,
    load_pattern,
    strip_prefix,
    table_from_leading_parts,
)
from gridloom.operators.clean import extension_filter, folder_filter
from gridloom.operators.lineage import cut
from gridloom.operators.recon import diff_report, diff_summary, megabytes, multiset_diff, section_lines, size_buckets
from gridloom.operators.schemas import file_schemas, group_report, group_totals, schema_groups
from gridloom.sources import writers
from gridloom.sources.catalog import folder_catalog
from gridloom.sources.files import list_files
from gridloom.sources.folder import file_catalog, read_list


def comparable_paths(
    listing: DataFrame, path: Column, prefix: str = "", include_ext: list[str] = (), exclude_ext: list[str] = (),
    include_folders: list[str] = (), exclude_folders: list[str] = (),
) -> DataFrame:
    """Relative, filtered and typographically normal paths of one side of a comparison."""
    relative = strip_prefix(path, prefix)
    keep = extension_filter(base_name(relative), list(include_ext), list(exclude_ext)) & folder_filter(
        directory(relative), list(include_folders), list(exclude_folders)
    )
    return listing.filter(keep).select(normalise_typography(relative).alias("path"))


def reconcile(left: DataFrame, right: DataFrame) -> DataFrame:
    return multiset_diff(left, right, ["path"])


def recon_job(spark: SparkSession, left_list: str, right_list: str, target: str, right_prefix: str = "", **filters) -> DataFrame:
    """Compare two list files, write the sectioned report, return the totals."""
    left = comparable_paths(read_list(spark, left_list), F.col("line"), **filters)
    right = comparable_paths(read_list(spark, right_list), F.col("line"), right_prefix, **filters)
    diff = reconcile(left, right)
    writers.write_parquet(diff, f"{target}/diff")
    diff = spark.read.parquet(f"{target}/diff")
    writers.write_sections(diff_report(diff, "path"), f"{target}/report")
    return diff_summary(diff)


def size_report_job(spark: SparkSession, source: str, target: str, low: float = 10, high: float = 50) -> DataFrame:
    """Size distribution of a folder and the list of its files."""
    files = file_catalog(spark, source).select("name", megabytes(F.col("size"), 2).alias("size_mb"))
    buckets = size_buckets(files, F.col("size_mb"), low, high)
    writers.write_csv(files, f"{target}/files")
    writers.write_csv(section_lines(buckets, "distribution"), f"{target}/summary", single=True)
    return buckets


def grouping_job(catalog: DataFrame, sizes: DataFrame, target: str, strict: bool = False) -> DataFrame:
    """Group files by schema, write the report and detail, return the totals.

    ``catalog`` is (file, ordinal, column, type), ``sizes`` is (file, size_mb).
    """
    schemas = file_schemas(catalog, strict).join(sizes, "file", "left")
    grouped = schema_groups(schemas, F.col("size_mb"))
    writers.write_parquet(grouped, f"{target}/groups")
    grouped = catalog.sparkSession.read.parquet(f"{target}/groups")
    report = group_report(grouped)
    writers.write_report(report, grouped, target)
    return group_totals(report)


def group_folder_job(spark: SparkSession, source: str, target: str, strict: bool = False) -> DataFrame:
    """Schema grouping of a folder; ``strict`` types CSV columns by their values."""
    bare = F.regexp_replace("path", "^([a-z0-9]+):/+", "$1:/")
    sizes = list_files(spark, source).select(bare.alias("file"), megabytes(F.col("length")).alias("size_mb"))
    return grouping_job(cut(folder_catalog(spark, source, infer=strict)), sizes, target, strict)


def load_tasks(files: DataFrame, path: Column, table: Column | None = None, order: Column | None = None) -> DataFrame:
    """One load task per derived table: the pattern of the path that is listed first.

    ``order`` is the place of a file in the listing; without one a listing is in the order of its paths.
    """
    named = files.select(path.alias("path"), (path if order is None else order).alias("place")).withColumn(
        "table", table_from_leading_parts(F.col("path")) if table is None else table
    )
    return named.groupBy("table").agg(
        F.min(F.struct("place", "path"))["path"].alias("first_path"), F.count("*").alias("files")
    ).withColumn("pattern", load_pattern(F.col("first_path")))
