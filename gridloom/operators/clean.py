"""Projections and row filters that turn raw rows into conforming ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.names import tidy_header

# Texts that mark a row as a heading or a notice, not data.
NOTICE_WORDS = ["disclosed", "name", "no data"]


def tidy_columns(df: DataFrame) -> DataFrame:
    """Rename all columns to unique snake case."""
    return df.toDF(*tidy_header(df.columns))


def conform(df: DataFrame, columns: list[str], missing: str | None = "") -> DataFrame:
    """Exactly these columns in this order; absent ones hold ``missing``, others are dropped."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") if c in have else F.lit(missing).cast("string").alias(c) for c in columns])


def all_string(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def fill_blank(df: DataFrame) -> DataFrame:
    """Nulls in text columns become the empty text."""
    return df.na.fill("")


def with_constants(df: DataFrame, values: dict[str, str]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def round_listed(df: DataFrame, columns: list[str], places: int = 2) -> DataFrame:
    """Round the listed columns that exist."""
    there = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), places) for c in there})


def or_default(value: Column, default: Column | str | int) -> Column:
    """Null and empty text give way to a default."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(F.nullif(value, F.lit("")), fallback)


def drop_empty_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.drop("all", subset=columns)


def pseudo_data(key: Column, legacy: bool = False) -> Column:
    """True where a key is absent, blank or a heading; ``legacy`` matches ``name`` inside words."""
    low = F.lower(key)
    words = [w if legacy else (rf"\b{w}\b" if w == "name" else w) for w in NOTICE_WORDS]
    return key.isNull() | (key == "") | low.rlike("|".join(words))


def tolerant_equal(left: Column, right: Column, within: float = 0.01) -> Column:
    """Equal as numbers within a tolerance, or equal as text."""
    near = F.abs(left.try_cast("double") - right.try_cast("double")) < within
    return F.coalesce(near, F.lit(False)) | (left == right)


def _suffixes(extensions: list[str]) -> str:
    clean = [e.strip().lstrip(".").strip() for e in extensions]
    return "|".join(rf"\.{e}" for e in clean if e)


def extension_filter(path: Column, include: list[str] = (), exclude: list[str] = ()) -> Column:
    """Case-sensitive suffix lists; an empty list does not filter."""
    keep = F.lit(True)
    if _suffixes(include):
        keep = keep & path.rlike(f"({_suffixes(include)})$")
    if _suffixes(exclude):
        keep = keep & ~path.rlike(f"({_suffixes(exclude)})$")
    return keep


def folder_filter(
    folder: Column, include: list[str] = (), exclude: list[str] = (), ignore_case: bool = False
) -> Column:
    """Any-of include patterns and none-of exclude patterns, unanchored."""
    flag = "(?i)" if ignore_case else ""

    def any_of(patterns: list[str]) -> Column | None:
        tests = [folder.rlike(flag + p.strip()) for p in patterns if p.strip()]
        return reduce(lambda a, b: a | b, tests) if tests else None

    keep = F.lit(True)
    wanted, unwanted = any_of(include), any_of(exclude)
    if wanted is not None:
        keep = keep & wanted
    if unwanted is not None:
        keep = keep & ~unwanted
    return keep


def keyword_filter(name: Column, keyword: str, extensions: list[str]) -> Column:
    low = F.lower(name)
    return low.contains(keyword.lower()) & low.rlike(f"({_suffixes(extensions)})$")


def copy_marked(name: Column) -> Column:
    """Workbooks whose name carries ``(1)`` to ``(5)``."""
    return name.rlike(r"\([1-5]\)") & name.rlike(r"\.(xlsx|xls|xlsm)$")
