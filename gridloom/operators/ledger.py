"""What was processed, what failed and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unprocessed(listing: DataFrame, ledger: DataFrame, listing_key: Column, ledger_key: Column) -> DataFrame:
    """Listing rows whose key is not in the ledger; ledger keys are made distinct first."""
    done = ledger.select(ledger_key.alias("_done")).distinct()
    return listing.join(done, listing_key == F.col("_done"), "left_anti")


def ledger_with(ledger: DataFrame, successes: DataFrame) -> DataFrame:
    return ledger.unionByName(successes).distinct()


def run_statistics(df: DataFrame, status: str, records: Column) -> DataFrame:
    """Files and records per status."""
    return df.groupBy(status).agg(F.count("*").alias("files"), F.sum(records).alias("records"))


def joined_reasons(df: DataFrame, keys: list[str], reason: str) -> DataFrame:
    """Distinct failure reasons per file, sorted and joined; reasons come from a fixed set of texts."""
    return df.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_set(reason)), "; ").alias("reasons"))


def completion(df: DataFrame, done: Column) -> DataFrame:
    """Whole percentage of finished rows, 0 on an empty table."""
    totals = df.agg(F.count("*").alias("total"), F.count(F.when(done, 1)).alias("done"))
    return totals.withColumn("percent", F.expr("if(total > 0, done * 100 div total, 0)"))


def marker_counts(lines: DataFrame, text: str, markers: dict[str, str]) -> DataFrame:
    """Lines holding each marker text."""
    return lines.agg(*[F.count(F.when(F.col(text).contains(m), 1)).alias(n) for n, m in markers.items()])


def quarantine(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Add ``status`` and ``reason``: the first failed check, in order, sends a row to quarantine."""
    reason = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in checks.items()])
    return df.withColumn("reason", reason).withColumn(
        "status", F.when(F.col("reason").isNull(), "ok").otherwise("quarantined")
    )


def check_budget(found: DataFrame | int, limit: int) -> None:
    """Raise when more rows than the budget are quarantined; a reader's own count spares the pass that counts them."""
    bad = found if isinstance(found, int) else found.filter("status = 'quarantined'").count()
    if bad > limit:
        raise ValueError(f"{bad} quarantined rows exceed the budget of {limit}")
