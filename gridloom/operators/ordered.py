"""Row-order operators that hold up when one key owns a large share of the table.

A window over a whole key puts that key into one task. Here keys are measured first. Keys that fit
a task use the plain window. A key above ``rows_per_task`` is cut into spans along its position quantiles;
each span is its own window, a small table of span summaries carries state across spans, and the
join back is on (key, span). No row is dropped or sampled and the result equals the plain window.
Measuring runs one aggregate over a sample of the key and position columns when the plan is built;
the sample only decides which way a key goes, every row takes part in the result.

``position`` is a numeric column that never decreases along ``order`` (a row number, an epoch).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Row, Window, WindowSpec
from pyspark.sql import functions as F

from gridloom.operators.lineage import cut as stored

ROWS_PER_TASK = 1_000_000
BROADCAST_KEYS = 10_000
SAMPLED_ROWS_OF_A_LARGE_KEY = 1_000
QUANTILES = 64


@dataclass(frozen=True)
class RowOrder:
    """Keys, total order within a key, and the numeric position behind that order.

    ``large`` holds the measured large keys; ``measured`` fills it once for a chain of steps over
    the same rows, otherwise each step measures its own input.
    """

    keys: list[str]
    order: list[str]
    position: Column
    rows_per_task: int = field(default_factory=lambda: ROWS_PER_TASK)
    large: list[Row] | DataFrame | None = None

    def window(self, *more: str) -> WindowSpec:
        return Window.partitionBy(*self.keys, *more).orderBy(*self.order)

    def with_keys(self, *more: str) -> RowOrder:
        """Finer keys. Parts of keys that all fit a task fit a task too."""
        known = self.large if self.large == [] else None
        return replace(self, keys=[*self.keys, *more], large=known)

    def measured(self, df: DataFrame) -> RowOrder:
        if self.large is not None:
            return self
        found = large_keys(df, self)
        some = found.limit(BROADCAST_KEYS + 1).collect()
        return replace(self, large=some if len(some) <= BROADCAST_KEYS else found)

    def large_table(self, df: DataFrame) -> DataFrame | None:
        """Large keys as a table: broadcast up to ``BROADCAST_KEYS``, beyond that joined by Spark."""
        if isinstance(self.large, DataFrame):
            return self.large
        if not self.large:
            return None
        return F.broadcast(df.sparkSession.createDataFrame(self.large, large_keys(df, self).schema))


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    match = F.lit(True)
    for key in keys:
        match = match & left[key].eqNullSafe(right[f"r_{key}"])
    return match


def _prefixed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({key: f"r_{key}" for key in keys})


def large_keys(df: DataFrame, by: RowOrder) -> DataFrame:
    """Keys above the task size with their position quantiles: at most rows / rows_per_task of them."""
    fraction = min(1.0, SAMPLED_ROWS_OF_A_LARGE_KEY / by.rows_per_task)
    shares = [i / QUANTILES for i in range(QUANTILES + 1)]
    rows = df.select(*by.keys, by.position.alias("_pos"))
    seen = rows if fraction == 1.0 else rows.sample(fraction, seed=7)
    return (
        seen.groupBy(*by.keys)
        .agg((F.count("*") / fraction).alias("_n"), F.percentile_approx("_pos", shares).alias("_bounds"))
        .filter(F.col("_n") > by.rows_per_task)
    )


def _span(by: RowOrder) -> Column:
    """Span number of a row: its quantile of the key's positions, then an even share of that range.

    It never decreases along the position, whatever the sample missed.
    """
    bounds, position = F.col("_bounds"), by.position
    passed = F.size(F.filter(bounds, lambda b: b <= position))
    per_quantile = F.ceil(F.col("_n") / F.lit(by.rows_per_task * QUANTILES))
    low, high = F.get(bounds, passed - 1), F.get(bounds, passed)
    share = (position - low) / (high - low + F.lit(1.0))
    return passed * per_quantile + F.coalesce(F.floor(share * per_quantile), F.lit(0))


def by_key_size(
    df: DataFrame,
    by: RowOrder,
    small: Callable[[DataFrame], DataFrame],
    large: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Run ``small`` on the keys that fit a task and ``large`` on the others, and unite the two.

    ``large`` sees the extra column ``_span``. Where there are large keys, the rows are stored once with their spans,
    so a step reads its input once and the plan of a chain of steps does not grow with its length.
    """
    found = by.measured(df).large_table(df)
    if found is None:
        return small(df)
    big = _prefixed(found, by.keys)
    match = _same(df, big, by.keys)
    span = F.when(F.col("_n").isNotNull(), _span(by))
    placed = stored(df.join(big, match, "left").select(*df.columns, span.alias("_span")))
    rest = placed.filter("_span is null").drop("_span")
    return small(rest).unionByName(large(placed.filter("_span is not null")))


def _attach(df: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """Left join a table that has one row per key set."""
    right = _prefixed(summary, keys)
    return df.join(right, _same(df, right, keys), "left").drop(*[f"r_{k}" for k in keys])


def _carry(df: DataFrame, by: RowOrder, values: dict[str, Column], forward: bool) -> DataFrame:
    """Last value up to a row (forward) or first value from a row on (backward), nulls skipped."""
    edge, pick = (F.last, F.max_by) if forward else (F.first, F.min_by)
    start, end = (
        (Window.unboundedPreceding, Window.currentRow)
        if forward
        else (Window.currentRow, Window.unboundedFollowing)
    )
    place = F.struct(*by.order)

    def small(part: DataFrame) -> DataFrame:
        span = by.window().rowsBetween(start, end)
        return part.withColumns({n: edge(v, ignorenulls=True).over(span) for n, v in values.items()})

    def large(part: DataFrame) -> DataFrame:
        cut = [*by.keys, "_span"]
        span = by.window("_span").rowsBetween(start, end)
        inside = part.withColumns({n: edge(v, ignorenulls=True).over(span) for n, v in values.items()})
        ends = part.groupBy(*cut).agg(
            *[pick(v, F.when(v.isNotNull(), place)).alias(f"_in_{n}") for n, v in values.items()]
        )
        before = Window.partitionBy(*by.keys).orderBy("_span")
        others = (
            before.rowsBetween(Window.unboundedPreceding, -1)
            if forward
            else before.rowsBetween(1, Window.unboundedFollowing)
        )
        carried = ends.select(
            *cut, *[edge(f"_in_{n}", ignorenulls=True).over(others).alias(f"_from_{n}") for n in values]
        )
        joined = _attach(inside, carried, cut)
        return joined.withColumns({n: F.coalesce(n, f"_from_{n}") for n in values}).drop(
            "_span", *[f"_from_{n}" for n in values]
        )

    return by_key_size(df, by, small, large)


def carry_forward(df: DataFrame, by: RowOrder, values: dict[str, Column]) -> DataFrame:
    """Add columns holding the latest non-null value at or before each row."""
    return _carry(df, by, values, forward=True)


def carry_backward(df: DataFrame, by: RowOrder, values: dict[str, Column]) -> DataFrame:
    """Add columns holding the nearest non-null value at or after each row."""
    return _carry(df, by, values, forward=False)


def running_sum(df: DataFrame, by: RowOrder, counts: dict[str, Column]) -> DataFrame:
    """Add running totals of whole numbers, current row included."""

    def total(spec: WindowSpec, amount: Column) -> Column:
        return F.sum(amount.cast("long")).over(spec)

    def small(part: DataFrame) -> DataFrame:
        so_far = by.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return part.withColumns({n: total(so_far, c) for n, c in counts.items()})

    def large(part: DataFrame) -> DataFrame:
        cut = [*by.keys, "_span"]
        so_far = by.window("_span").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        inside = part.withColumns({n: total(so_far, c) for n, c in counts.items()})
        sums = part.groupBy(*cut).agg(*[F.sum(c.cast("long")).alias(f"_in_{n}") for n, c in counts.items()])
        earlier = Window.partitionBy(*by.keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sums.select(*cut, *[F.sum(f"_in_{n}").over(earlier).alias(f"_from_{n}") for n in counts])
        joined = _attach(inside, offsets, cut)
        return joined.withColumns(
            {n: F.col(n) + F.coalesce(F.col(f"_from_{n}"), F.lit(0)) for n in counts}
        ).drop("_span", *[f"_from_{n}" for n in counts])

    return by_key_size(df, by, small, large)


def number_rows(df: DataFrame, by: RowOrder, name: str) -> DataFrame:
    """Add the row number within the key, from 1."""
    return running_sum(df, by, {name: F.lit(1)})


def look_around(
    df: DataFrame,
    by: RowOrder,
    before: int,
    after: int,
    compute: Callable[[WindowSpec], dict[str, Column]],
) -> DataFrame:
    """Window expressions that reach at most ``before`` rows back and ``after`` rows ahead.

    Large keys are numbered and cut into even blocks; each block also receives copies of the few
    neighbouring rows its windows can reach, and the copies are dropped afterwards.
    """
    block_rows = max(by.rows_per_task, before + after + 1)

    def small(part: DataFrame) -> DataFrame:
        return part.withColumns(compute(by.window()))

    def large(part: DataFrame) -> DataFrame:
        cut = [*by.keys, "_span"]
        local = F.row_number().over(by.window("_span"))
        sizes = part.groupBy(*cut).agg(F.count("*").alias("_rows"))
        earlier = Window.partitionBy(*by.keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(*cut, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
        placed = _attach(part.withColumn("_local", local), offsets, cut)
        row = F.col("_offset") + F.col("_local") - 1
        home = F.floor(row / block_rows)
        inside = row % block_rows
        blocks = F.array_compact(
            F.array(
                home,
                F.when((inside < after) & (home > 0), home - 1),
                F.when(inside >= block_rows - before, home + 1),
            )
        )
        spread = placed.withColumn("_home", home).withColumn("_block", F.explode(blocks))
        done = spread.withColumns(compute(by.window("_block")))
        return done.filter(F.col("_block") == F.col("_home")).drop(
            "_span", "_local", "_offset", "_home", "_block"
        )

    return by_key_size(df, by, small, large)


def ordered_concat(df: DataFrame, by: RowOrder, lists: dict[str, Column], separator: str = "; ") -> DataFrame:
    """One row per key: each expression's non-null texts joined in row order, and the row count.

    Rows are brought together before they are collected, as collecting earlier would not shrink them.
    Large keys are concatenated span by span, so no task holds more than a span's texts plus the
    finished pieces of its own key.
    """
    names = list(lists)

    def joined(part: DataFrame, keys: list[str], place: Column, texts: dict[str, Column], rows: Column) -> DataFrame:
        some = F.coalesce(*[t.cast("string") for t in texts.values()]).isNotNull()
        item = F.struct(place.alias("o"), *[t.alias(n) for n, t in texts.items()])
        together = part.repartition(*keys)
        made = together.groupBy(*keys).agg(
            rows.alias("row_count"), F.sort_array(F.collect_list(F.when(some, item))).alias("_items")
        )
        return made.select(
            *keys, "row_count", *[F.array_join(F.col("_items")[n], separator).alias(n) for n in names]
        )

    def small(part: DataFrame) -> DataFrame:
        return joined(part, by.keys, F.struct(*by.order), lists, F.count("*"))

    def large(part: DataFrame) -> DataFrame:
        pieces = joined(part, [*by.keys, "_span"], F.struct(*by.order), lists, F.count("*"))
        texts = {n: F.nullif(F.col(n), F.lit("")) for n in names}
        return joined(pieces, by.keys, F.col("_span"), texts, F.sum("row_count"))

    return by_key_size(df, by, small, large)
