"""Conditional counts, label pivots, parent/child summaries and default rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.operators.ordered import RowOrder, ordered_concat


def _place(order: list[str]) -> Column:
    """Ordering value. A lone column stays plain, which lets Spark aggregate by hash, not by sort."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def conditional_counts(
    df: DataFrame, keys: list[str], category: str, categories: dict[str, str],
    first: list[str] = (), order: list[str] = (), match: str = "exact",
) -> DataFrame:
    """Count rows per category value, the total, and the first value of lineage columns.

    ``match="contains"`` also counts categories that carry the value inside a longer text.
    """
    cat = F.col(category)

    def hit(value: str) -> Column:
        return cat == value if match == "exact" else cat.contains(value)

    place = _place(order)
    return df.groupBy(*keys).agg(
        *[F.min_by(c, place).alias(c) for c in first],
        *[F.count(F.when(hit(v), 1)).alias(n) for n, v in categories.items()],
        F.count("*").alias("total_count"),
    )


def custom_rank(value: Column, ranking: list[str]) -> Column:
    """Position of a value in a fixed order, unknown values last."""
    rank = F.when(value == ranking[0], F.lit(1))
    for i, name in enumerate(ranking[1:], start=2):
        rank = rank.when(value == name, F.lit(i))
    return rank.otherwise(F.lit(len(ranking) + 1))


def reduction(counts: DataFrame, per_group: str) -> DataFrame:
    """Rows in, rows out, reduction percent and ratio of a roll-up; null on empty input."""
    both = counts.agg(
        F.coalesce(F.sum(per_group), F.lit(0)).alias("rows_in"), F.count("*").alias("rows_out")
    )
    rows_in, rows_out = F.col("rows_in"), F.col("rows_out")
    return both.select(
        "rows_in",
        "rows_out",
        F.when(rows_in > 0, F.round((rows_in - rows_out) * 100.0 / rows_in, 2)).alias("reduction_pct"),
        F.when(rows_out > 0, F.round(rows_in * 1.0 / rows_out, 2)).alias("ratio"),
    )


def wide_summary(
    parents: DataFrame, children: DataFrame, key: str, order: RowOrder, lists: dict[str, Column], count: str
) -> DataFrame:
    """Parents with their children's texts joined in order and counted; childless parents get 0 and ''."""
    rolled = ordered_concat(children, order, lists).withColumnRenamed("row_count", count)
    joined = parents.join(rolled, key, "left")
    return joined.withColumns(
        {count: F.coalesce(count, F.lit(0)), **{n: F.coalesce(n, F.lit("")) for n in lists}}
    )


def first_values(
    df: DataFrame, keys: list[str], label: str, value: Column, order: list[str],
    labels: dict[str, str], last: list[str] = (),
) -> DataFrame:
    """One column per label with the first value in row order (the last for labels in ``last``)."""
    place = _place(order)

    def pick(name: str, wanted: str) -> Column:
        hit = F.when((F.col(label) == wanted) & value.isNotNull(), place)
        return (F.max_by if name in last else F.min_by)(value, hit).alias(name)

    return df.groupBy(*keys).agg(*[pick(n, w) for n, w in labels.items()])


def present(taxonomy: DataFrame, df: DataFrame, on: Column) -> DataFrame:
    """Taxonomy entries that occur in a table."""
    return taxonomy.join(df, on, "left_semi")


def default_rows(
    parents: DataFrame, children: DataFrame, key: str, defaults: list[dict[str, str]]
) -> DataFrame:
    """The fixed default rows for every parent that has no child."""
    lone = parents.join(children.select(key).distinct(), key, "left_anti")
    entry = [F.struct(*[F.lit(v).alias(n) for n, v in d.items()]) for d in defaults]
    return lone.withColumn("_d", F.explode(F.array(*entry))).select(*parents.columns, "_d.*")


def placeholders(parents: DataFrame, having: DataFrame, key: str, rows: int = 4) -> DataFrame:
    """``rows`` numbered blank rows for every parent without a match in ``having``."""
    lone = parents.join(having.select(key).distinct(), key, "left_anti")
    return lone.withColumn("placeholder", F.explode(F.sequence(F.lit(1), F.lit(rows))))
