"""Places of rows in an order of the whole table, without one task that sees all of them."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from gridloom.llm.staging import staged

#: Bits of the place within a partition in what ``monotonically_increasing_id`` gives.
_WITHIN = 33


def numbered(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """The rows of ``df``, stored, with their place from 1 under ``order`` as long.

    Ranges of the order go to one task each; a task numbers its own rows, and sums of the rows before it are added. Rows
    that tie in everything are spread as well and get places in no stated order. Column names beginning with ``_`` are
    taken. The driver sees one number a partition.
    """
    dealt = df.withColumn("_tie", F.rand(1))
    dealt = dealt.repartitionByRange(*order, F.col("_tie")).sortWithinPartitions(*order, F.col("_tie")).drop("_tie")
    placed = staged(dealt.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _WITHIN).cast("int")
    rows = dict(map(tuple, placed.groupBy(part.alias("part")).agg(F.count(F.lit(1))).collect()))
    before = [0, *accumulate(rows.get(i, 0) for i in range(max(rows, default=0)))]
    within = F.col("_at") - F.shiftleft(part.cast("long"), _WITHIN)
    return placed.withColumn(name, F.get(F.lit(before).cast("array<long>"), part) + within + 1).drop("_at")
