"""Comparison of two listings as multisets, size distributions and run selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def multiset_diff(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Copies of each key on either side and how many are missing or common.

    Copies are counted before the shuffle, so a key with very many copies is one small row per task.
    """
    sides = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionAll(
        right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    counts = sides.groupBy(*keys).agg(F.sum("_l").alias("left_count"), F.sum("_r").alias("right_count"))
    l, r = F.col("left_count"), F.col("right_count")
    return counts.withColumns(
        {
            "left_only": F.greatest(l - r, F.lit(0)),
            "right_only": F.greatest(r - l, F.lit(0)),
            "common": F.least(l, r),
        }
    )


def diff_summary(diff: DataFrame) -> DataFrame:
    """Totals over a ``multiset_diff``."""
    names = {
        "left_count": "left_total", "right_count": "right_total", "common": "common_total",
        "left_only": "missing_in_right", "right_only": "missing_in_left",
    }
    return diff.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in names.items()])


def diff_report(diff: DataFrame, key: str) -> DataFrame:
    """Long report (section, value, copies): a summary section and one section per non-empty list."""
    lists = {
        "left": "left_count", "right": "right_count", "common": "common",
        "missing_in_right": "left_only", "missing_in_left": "right_only",
    }
    entries = [F.struct(F.lit(s).alias("section"), F.col(c).alias("copies")) for s, c in lists.items()]
    listed = (
        diff.withColumn("e", F.explode(F.array(*entries)))
        .filter("e.copies > 0")
        .select("e.section", F.col(key).cast("string").alias("value"), F.col("e.copies").alias("copies"))
    )
    totals = diff_summary(diff)
    lines = [F.struct(F.lit(c).alias("value"), F.col(c).alias("copies")) for c in totals.columns]
    summary = totals.select(F.explode(F.array(*lines)).alias("e")).select(
        F.lit("summary").alias("section"), "e.value", "e.copies"
    )
    return summary.unionByName(listed)


def expand_copies(df: DataFrame, copies: str, chunk: int = 10_000) -> DataFrame:
    """One row per copy. Long runs are cut into chunks that are spread before they are written out."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, F.lit(chunk).cast("long")))
    cut = df.filter(F.col(copies) > 0).withColumn("_start", starts).repartition(parts)
    length = F.least(F.col(copies) - F.col("_start"), F.lit(chunk))
    return cut.withColumn("_i", F.explode(F.sequence(F.lit(1).cast("long"), length))).drop("_i", "_start", copies)


def megabytes(length: Column, places: int | None = None) -> Column:
    size = length / F.lit(1048576)
    return size if places is None else F.round(size, places)


def size_buckets(df: DataFrame, size: Column, low: float = 10, high: float = 50) -> DataFrame:
    """Counts below, between (both ends included) and above two sizes, with count and total."""
    sized = df.select(size.alias("s"))
    s = F.col("s")
    return sized.agg(
        F.count("*").alias("total_files"),
        F.round(F.coalesce(F.sum(s), F.lit(0.0)), 2).alias("total_size"),
        F.count(F.when(s < low, 1)).alias("below"),
        F.count(F.when(s.between(low, high), 1)).alias("between"),
        F.count(F.when(s > high, 1)).alias("above"),
    )


def latest_run(df: DataFrame, run: str) -> DataFrame:
    """Rows of the greatest run id; the single maximum is a scalar side of the join."""
    newest = df.agg(F.max(run).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(run) == F.col("_newest")).drop("_newest")


def section_lines(summary: DataFrame, section: str) -> DataFrame:
    """One-row table as (section, value, copies)-like label lines for a report bundle."""
    lines = [
        F.struct(F.lit(c).alias("label"), F.col(c).cast("string").alias("value")) for c in summary.columns
    ]
    return summary.select(F.lit(section).alias("section"), F.explode(F.array(*lines)).alias("e")).select(
        "section", "e.label", "e.value"
    )


def unite(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
