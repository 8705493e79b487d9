"""Mixing sources to target weights by nested thresholds on hashed ids.

Sizes are words. Weights share all words among the sources; a source gives its words ``most`` times at most, and what
it cannot give is shared again. Whole repeats come first. For the rest, rows of a source are taken in the order of a
hash of their id up to the budget, without sorting them: sizes are summed by source and hash bucket, the bucket in
which the budget ends is found, and only that bucket is summed again, by the next bits of the hash. Every level reads a
4096th of the rows of the one before. What remains is a threshold a source, a filter on each row alone. A smaller
budget has a lower threshold on the same hashes, so mixes are nested.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridloom.llm.ranks import numbered
from gridloom.llm.staging import FEW, staged

#: Bits of the hash that a histogram resolves, and levels of histograms.
BITS, LEVELS = 12, 4
#: Parts that the rows of a source are dealt into where the list of sources is too long to be sent to every task.
SALTS = 64
#: Exact products of sizes and weights.
_WIDE = "decimal(38,0)"


def words(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def place_of(key: Column, seed: str) -> Column:
    """A number below 2^48 that the id alone decides; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 1, BITS * LEVELS // 4), 16, 10).cast("long")


def beside(rows: DataFrame, facts: DataFrame, on: str) -> DataFrame:
    """Rows with the facts of their source, null being a source; ``facts`` has a row a source.

    Few sources are sent to every task. Many are joined, and the rows of a source are dealt over ``SALTS`` keys, so
    that a source with a large share of all rows is no single task's work.
    """
    if facts.count() <= FEW // 10:
        right = F.broadcast(facts.withColumnRenamed(on, "_on"))
        return rows.join(right, rows[on].eqNullSafe(right["_on"])).drop("_on")
    salted = rows.withColumn("_salt", F.floor(F.rand(1) * SALTS).cast("int"))
    right = facts.withColumnRenamed(on, "_on").withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    both = salted.join(right, salted[on].eqNullSafe(right["_on"]) & (F.col("_salt") == F.col("_part")))
    return both.drop("_on", "_salt", "_part")


def targets(sources: DataFrame, most: int, total: int | None = None) -> DataFrame:
    """``sources`` (source_size, weight and more) with target, and its exact numerator and denominator (over, under).

    A target is weight * rest / open weights, ``rest`` being the words that full sources do not give. A source is full
    where that is above ``most`` times its words. A round fills sources or ends; the driver sees sums.
    """
    limit, weight = (F.col("source_size") * most).cast(_WIDE), F.col("weight").cast(_WIDE)
    exact = lambda number: F.lit(Decimal(number)).cast(_WIDE)
    everything, weights = (int(x or 0) for x in sources.agg(F.sum("source_size"), F.sum("weight")).first())
    wanted = everything if total is None else min(total, most * everything)
    rest, open_weights = wanted, weights
    while True:
        full = weight * exact(rest) > limit * exact(open_weights) if open_weights else F.lit(True)
        given, closed = (int(x or 0) for x in sources.agg(F.sum(F.when(full, limit)), F.sum(F.when(full, weight))).first())
        if (wanted - given, weights - closed) == (rest, open_weights):
            break
        rest, open_weights = wanted - given, weights - closed
    over = F.when(full, limit).otherwise(weight * exact(rest))
    under = F.when(full, F.lit(1)).otherwise(open_weights or 1).cast("long")
    return sources.withColumns({"over": over, "under": under, "target": over.cast("double") / under})


def end_of(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """The bucket in which the budget of each source ends: no, bucket, before (words in lower buckets), alike (rows).

    A source whose budget is not reached has none. Buckets of a source number 4096 at most, or sizes of rows that share
    one hash.
    """
    summed = rows.groupBy("no", "bucket").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("alike"))
    lower = Window.partitionBy("no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    ends = summed.withColumn("before", F.coalesce(F.sum("words").over(lower), F.lit(0))).join(budgets, "no")
    ends = ends.filter(F.col("before") + F.col("words") > F.col("budget"))
    first = F.min(F.struct("bucket", "before", "alike", "budget", "last"))
    return ends.groupBy("no").agg(first.alias("x")).select("no", "x.*")


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """Where the budget of each source (no, budget) ends: no, last (hash), last_size, extra (rows taken among those of
    that hash and size), alike (number of those).

    Of the rows in hash order, those are taken whose middle word lies within the budget. All rows below the hash are
    taken, and so are smaller ones of the same hash.
    """
    budgets, inside = budgets.withColumn("last", F.lit(0).cast("long")), rows.select("no", "h", "size")
    for level in range(LEVELS):
        bits = F.shiftright("h", BITS * (LEVELS - 1 - level)).bitwiseAND(F.lit(2**BITS - 1))
        dealt = inside.withColumn("bucket", bits)
        ends = staged(end_of(dealt, budgets))
        inside = staged(dealt.join(ends.select("no", "bucket"), ["no", "bucket"]).drop("bucket"))
        budgets = ends.select("no", (F.col("budget") - F.col("before")).alias("budget"),
                              (F.col("last") * 2**BITS + F.col("bucket")).alias("last"))
    ends = end_of(inside.withColumn("bucket", F.col("size")), budgets)
    extra = F.floor((F.col("budget") - F.col("before")) / F.col("bucket") + 0.5)
    return staged(ends.select("no", "last", F.col("bucket").alias("last_size"), extra.alias("extra"), "alike"))


def mix(df: DataFrame, weights, most: int = 3, total: int | None = None, seed: str = "mix", key: str = "doc_id",
        text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target (of its source) and taken (words that the mix takes) of every row.

    ``weights`` is a function of the sources (no, source, source_size; numbered by code point, null last) that adds an
    integer column weight of 1 or more. ``total`` is the number of words to take, all by default. A row is taken whole,
    0 to ``most`` times, and within a source taken words differ from the target by half a row at most. Null texts have
    size 0 and are never taken; a null source is a source. Rows that repeat an id are rows of their own that hash alike:
    where the budget ends among them, smaller ones go first, and of equal ones some are taken, which does not show in
    the result. An empty table gives no rows. Other columns are not read.
    """
    rows = staged(df.select(
        df[key].cast("long").alias("doc_id"), df[source].cast("string").alias("source"), words(df[text]).alias("size"),
        place_of(df[key], seed).alias("h")))
    sources = numbered(rows.groupBy("source").agg(F.sum("size").alias("source_size")), [F.asc_nulls_last("source")], "no")
    facts = targets(weights(sources), most, total)
    # Whole repeats, and what is left of the target after them.
    repeats = F.when(F.col("source_size") > 0, F.expr(f"cast(over div (under * cast(source_size as {_WIDE})) as int)")).otherwise(0)
    facts = facts.withColumn("repeats", repeats)
    spare = F.col("over") - F.col("under") * F.col("source_size") * F.col("repeats")
    facts = staged(facts.withColumn("budget", spare.cast("double") / F.col("under")).drop("over", "under", "weight"))
    placed = staged(beside(rows, facts, "source").select(
        "doc_id", "source", "size", "h", "no", "source_size", "target", "repeats"))
    ends = thresholds(placed, facts.select("no", "budget"))
    whole = staged(beside(placed, facts.select("no").join(ends, "no", "left"), "no"))
    below = F.col("last").isNull() | (F.col("h") < F.col("last")) | ((F.col("h") == F.col("last")) & (F.col("size") < F.col("last_size")))
    at_end = F.coalesce((F.col("h") == F.col("last")) & (F.col("size") == F.col("last_size")), F.lit(False))
    several = ends.filter("alike > 1 and extra > 0 and extra < alike")
    if several.isEmpty():
        once = below | (at_end & (F.col("extra") > 0))
        done = whole.withColumn("once", once)
    else:
        shared = at_end & (F.col("alike") > 1)
        order = numbered(whole.filter(shared), [F.asc("no")], "at")
        first = beside(order, order.groupBy("no").agg(F.min("at").alias("first")), "no")
        done = whole.filter(~shared).withColumn("once", below | (at_end & (F.col("extra") > 0))).unionByName(
            first.withColumn("once", F.col("at") - F.col("first") < F.col("extra")).drop("at", "first"))
    taken = F.col("size") * (F.col("repeats") + F.coalesce(F.col("once"), F.lit(False)).cast("int"))
    return done.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))
