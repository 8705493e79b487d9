"""Union by name, duplicate removal and bounded selections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FAMILY = {
    T.ByteType: "number", T.ShortType: "number", T.IntegerType: "number", T.LongType: "number",
    T.FloatType: "number", T.DoubleType: "number", T.DecimalType: "number",
    T.DateType: "time", T.TimestampType: "time", T.TimestampNTZType: "time",
    T.StringType: "text", T.BooleanType: "boolean",
}


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union on column names, absent columns null.

    Spark widens types of one family by itself; columns whose families differ become text, since a
    number beside a text would otherwise fail at run time on the first text that is no number.
    """
    if not frames:
        raise ValueError("nothing to unite")
    families: dict[str, set[str]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            if not isinstance(field.dataType, T.NullType):
                family = _FAMILY.get(type(field.dataType), field.dataType.simpleString())
                families.setdefault(field.name, set()).add(family)
    mixed = {name for name, kinds in families.items() if len(kinds) > 1}

    def prepared(frame: DataFrame) -> DataFrame:
        return frame.select(
            *[F.col(f"`{c}`").cast("string").alias(c) if c in mixed else F.col(f"`{c}`") for c in frame.columns]
        )

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), map(prepared, frames))


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def first_per_key(df: DataFrame, subset: list[str], tie_break: list) -> DataFrame:
    """One row per key, the first by ``tie_break``.

    The rank filter is pushed below the shuffle, so each task sends at most one row per key.
    """
    place = F.row_number().over(Window.partitionBy(*subset).orderBy(*tie_break))
    return df.withColumn("_place", place).filter("_place = 1").drop("_place")


def any_per_key(df: DataFrame, subset: list[str]) -> DataFrame:
    """One arbitrary row per key; cheaper than ``first_per_key`` but not repeatable."""
    return df.dropDuplicates(subset)


def digest(text: Column) -> Column:
    """Texts of 64 characters and more as their SHA-256 in 64 characters, shorter ones as they are."""
    return F.when(F.length(text) >= 64, F.sha2(text, 256)).otherwise(text)


def dedup_stats(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Original, kept and removed rows and the removed percentage (null on empty input).

    Long texts are counted by their SHA-256, so the shuffle carries digests and not documents.
    """
    names = subset or df.columns
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    keys = [digest(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`") for c in names]
    copies = df.select(*keys).groupBy(*[f"`{c}`" for c in names]).agg(F.count("*").alias("copies"))
    totals = copies.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("original"), F.count("*").alias("kept")
    )
    removed = F.col("original") - F.col("kept")
    percent = F.when(F.col("original") > 0, F.round(removed * 100.0 / F.col("original"), 2))
    return totals.select("original", "kept", removed.alias("removed"), percent.alias("removed_pct"))


def head_per_key(df: DataFrame, keys: list[str], order: list, n: int) -> DataFrame:
    """First ``n`` rows per key; tasks send at most ``n`` rows per key to the shuffle."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def top_rows(df: DataFrame, order: list, n: int) -> DataFrame:
    """First ``n`` rows of the whole table in a total order."""
    return df.orderBy(*order).limit(n)


def sample_above(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """Random ``n`` rows, the same ones on every run; a table of at most ``n`` rows comes back whole.

    The order is that of a hash of seed and keys, so it does not depend on partitions; keys tell rows apart.
    """
    return df.orderBy(F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])), *keys).limit(n)
