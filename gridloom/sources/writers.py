"""Writers. Parallel part files are the default; a single file is asked for explicitly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Write dispositions; anything else overwrites.
DISPOSITIONS = {"TRUNCATE": "overwrite", "APPEND": "append", "EMPTY": "error"}


def mode_of(disposition: str) -> str:
    word = disposition.upper().removeprefix("WRITE_")
    return DISPOSITIONS.get(word, "overwrite")


def write_csv(
    df: DataFrame, path: str, single: bool = False, quote_all: bool = False, disposition: str = "TRUNCATE"
) -> None:
    """CSV with a header. ``single`` funnels the table through one task: for small results only."""
    out = (df.coalesce(1) if single else df).write.mode(mode_of(disposition)).option("header", True)
    if quote_all:
        out = out.option("quoteAll", True).option("escape", '"')
    out.csv(path)


def write_parquet(df: DataFrame, path: str, disposition: str = "TRUNCATE") -> None:
    df.write.mode(mode_of(disposition)).parquet(path)


def write_json(df: DataFrame, path: str, disposition: str = "TRUNCATE") -> None:
    df.write.mode(mode_of(disposition)).json(path)


def write_format(df: DataFrame, path: str, fmt: str, single: bool = False) -> None:
    if fmt == "csv":
        write_csv(df, path, single)
    elif fmt == "parquet":
        write_parquet(df, path)
    elif fmt == "json":
        write_json(df, path)
    else:
        raise ValueError(f"unsupported output format {fmt}")


def write_sections(report: DataFrame, path: str) -> None:
    """One folder per report section, sorted within; sections without rows do not appear."""
    ordered = report.repartitionByRange("section", *[c for c in report.columns if c != "section"])
    ordered.sortWithinPartitions(*report.columns).write.mode("overwrite").partitionBy("section").parquet(path)


def write_bundle(tables: dict[str, DataFrame], path: str) -> list[str]:
    """Several tables side by side; empty ones are skipped. Returns the names written."""
    written = []
    for name, table in tables.items():
        if not table.isEmpty():
            write_csv(table, f"{path}/{name}")
            written.append(name)
    return written


def create_typed_table(df: DataFrame, table: str) -> int:
    """Replace a managed table and return its row count, read back from what was written."""
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table).count()


def write_report(groups: DataFrame, detail: DataFrame, path: str) -> None:
    """Group lines as text and the per-file detail as JSON."""
    # Fixed value: the report line.
    line = F.format_string(
        "Group: %s | Reason: %s | Recommended: %s | Files: %d | Total Size: %.2f MB | Similarity: %.2f",
        "group_name", "reason", "recommended_name", "total_files", "total_size_mb", "similarity",
    )
    groups.orderBy("group_name").select(line.alias("value")).write.mode("overwrite").text(f"{path}/report")
    write_json(detail, f"{path}/detail")
