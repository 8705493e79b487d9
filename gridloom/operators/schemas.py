"""Schemas as data: profiles, fingerprints, drift, similarity and grouping of files.

A column catalog is a long table (file, ordinal, column, type). A file's columns always form a
small group; the number of files may be large and one schema may be shared by very many of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.casts import type_bucket
from gridloom.functions.names import schema_name
from gridloom.operators.dedup import digest
from gridloom.operators.lineage import cut
from gridloom.operators.ordered import RowOrder, number_rows

NAME_WEIGHT = 0.7
TYPE_WEIGHT = 0.3
THRESHOLD = 0.8
#: Schemas with one name that meet the others with it in one part.
HELD_AT_ONCE = 4096


def column_profile(df: DataFrame, ids: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """Per column: non-null and distinct counts, first three values, text lengths, numeric range.

    Values are counted per (column, value) before any column-wide aggregate, so a frequent value
    travels as one row per task, long texts as digests; the first three values come from a rank pushed below the shuffle.
    """
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in _NUMERIC}
    cells = df.select(
        *ids,
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.lit(c in numeric).alias("is_number"),
                        F.col(c).cast("string").alias("value"),
                    )
                    for c in columns
                ]
            )
        ).alias("e"),
    ).select(*ids, "e.*")
    filled = cells.filter("value is not null")
    short = filled.select(
        "column", "is_number", digest(F.col("value")).alias("value"), F.length("value").alias("length")
    )
    values = short.groupBy("column", "is_number", "value", "length").agg(F.count("*").alias("n"))
    length = F.when(~F.col("is_number"), F.col("length"))
    number = F.when(F.col("is_number"), F.col("value").try_cast("double"))
    n = F.col("n")
    stats = values.groupBy("column").agg(
        F.sum("n").alias("non_null_count"),
        F.count("*").alias("distinct_count"),
        F.round(F.sum(length * n) / F.sum(F.when(length.isNotNull(), n)), 4).alias("avg_length"),
        F.max(length).alias("max_length"),
        F.min(number).alias("min_value"),
        F.max(number).alias("max_value"),
        F.round(F.sum(number * n) / F.sum(F.when(number.isNotNull(), n)), 4).alias("avg_value"),
    )
    place = F.row_number().over(Window.partitionBy("column").orderBy(*order))
    first = filled.withColumn("p", place).filter("p <= 3")
    samples = first.groupBy("column").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("p", "value")))["value"], "; ").alias("first_values")
    )
    return stats.join(samples, "column", "left")


_NUMERIC = {"byte", "short", "integer", "long", "float", "double", "decimal"}


def capped_count(df: DataFrame, keys: list[str], cap: int) -> DataFrame:
    """Row count per key up to a cap and whether there were more."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.select(*keys, F.least("n", F.lit(cap)).alias("rows"), (F.col("n") > cap).alias("more"))


def catalog_of(frames: dict[str, DataFrame]) -> list[tuple[str, int, str, str]]:
    """Catalog rows of DataFrames that are already open; only schemas are read."""
    return [
        (name, i, field.name, field.dataType.simpleString())
        for name, frame in frames.items()
        for i, field in enumerate(frame.schema.fields)
    ]


def file_schemas(catalog: DataFrame, strict: bool = False) -> DataFrame:
    """One row per file: fingerprint, column count, and its columns with and without type bucket.

    The fingerprint is the md5 of the sorted ``name:bucket`` pairs, so column order is irrelevant.
    """
    bucket = type_bucket(F.col("type"), strict)
    pair = F.concat_ws(":", schema_name(F.col("column")), bucket)
    typed = F.concat_ws(":", F.col("column"), bucket)
    return catalog.repartition("file").groupBy("file").agg(
        F.md5(F.array_join(F.sort_array(F.collect_list(pair)), "|").cast("binary")).alias("fingerprint"),
        F.count("*").alias("column_count"),
        F.sort_array(F.collect_set("column")).alias("names"),
        F.sort_array(F.collect_set(typed)).alias("typed"),
    )


def fingerprint_groups(schemas: DataFrame, size: Column, minimum: int = 2) -> DataFrame:
    """Files sharing a fingerprint: count, total size and the first file with its columns."""
    groups = schemas.groupBy("fingerprint").agg(
        F.count("*").alias("total_files"),
        F.round(F.sum(size), 2).alias("total_size_mb"),
        F.min("file").alias("first_file"),
        F.min(F.struct("file", "typed"))["typed"].alias("sample_schema"),
    )
    return groups.filter(F.col("total_files") >= minimum)


def group_totals(groups: DataFrame) -> DataFrame:
    return groups.agg(
        F.coalesce(F.sum("total_files"), F.lit(0)).alias("files"),
        F.round(F.coalesce(F.sum("total_size_mb"), F.lit(0.0)), 2).alias("size_mb"),
        F.count("*").alias("groups"),
    )


def schema_drift(expected: DataFrame, actual: DataFrame, keys: list[str] = ()) -> DataFrame:
    """Full outer comparison of two (name, type) lists on lower-cased names, per table key if given.

    ``action`` says what a load does: cast a matched column, null a missing one, keep an extra
    STRING column and refuse any other extra column.
    """
    e = expected.select(*keys, F.lower("name").alias("column"), F.col("type").alias("expected_type"))
    a = actual.select(*keys, F.lower("name").alias("column"), F.upper("type").alias("actual_type"))
    both = e.join(a, [*keys, "column"], "full_outer")
    status = (
        F.when(F.col("expected_type").isNull(), "extra")
        .when(F.col("actual_type").isNull(), "missing")
        .otherwise("matched")
    )
    action = (
        F.when(status == "matched", "cast")
        .when(status == "missing", "null")
        .when(F.col("actual_type") == "STRING", "keep")
        .otherwise("error")
    )
    return both.select(
        *keys, "column", "expected_type", "actual_type", status.alias("status"), action.alias("action")
    )


def similarity(names_a: Column, names_b: Column, typed_a: Column, typed_b: Column) -> Column:
    """0.7 x Jaccard of the names + 0.3 x share of common names with equal buckets, 9 decimals."""
    common = F.size(F.array_intersect(names_a, names_b))
    union = F.size(names_a) + F.size(names_b) - common
    types = F.when(common > 0, F.size(F.array_intersect(typed_a, typed_b)) / common).otherwise(F.lit(0.0))
    score = F.when(union > 0, common / union * NAME_WEIGHT + types * TYPE_WEIGHT).otherwise(F.lit(0.0))
    return F.round(score, 9)


def _least_jaccard(threshold: float) -> float:
    return max(0.0, (threshold - TYPE_WEIGHT) / NAME_WEIGHT)


def _name_counts(schemas: DataFrame) -> DataFrame:
    return schemas.select(F.explode("names").alias("name")).groupBy("name").agg(F.count("*").alias("held"))


def _prefixes(schemas: DataFrame, counts: DataFrame, threshold: float, keep: list[str]) -> DataFrame:
    """Prefix names of each schema, a row each: what is kept, name, place (from 0) and the number of schemas that hold it.

    Names come rarest first, so one that most schemas hold is in a prefix only where a schema has little else. Two
    schemas that can pass share a name of both prefixes, since too few names are left behind them.
    """
    named = schemas.select(*keep, F.explode("names").alias("name")).join(counts, "name")
    entry = F.struct("held", F.xxhash64("name").alias("hash"), "name")
    ordered = named.groupBy(*keep).agg(F.sort_array(F.collect_list(entry)).alias("order"))
    n = F.size("order")
    kept = F.least(n, n - F.ceil(F.round(n * F.lit(_least_jaccard(threshold)), 9)) + 1)
    return ordered.select(*keep, n.alias("n"), F.posexplode(F.slice("order", F.lit(1), kept.cast("int"))).alias("place", "x")).select(
        *keep, "n", "place", "x.name", "x.held")


def similar_to(schemas: DataFrame, bases: DataFrame, threshold: float = THRESHOLD, earlier: bool = False) -> DataFrame:
    """Pairs (file, base_file, score) of every schema and every similar base schema.

    Score and sizes bound the common names from below, so the join runs on the rarest names of each schema, drops
    unequal sizes, and drops a pair where the names behind the shared one are too few on either side. Schemas with a name
    that very many hold are dealt into parts, each of which meets all bases with it. A pair is scored once, whatever it
    shares. ``earlier`` keeps bases of lower ``ord`` only; both sides need that column then.
    """
    least = _least_jaccard(threshold)
    order = ["ord"] if earlier else []
    rows = schemas.select("file", *order, "names", "typed")
    others = bases.select("file", *order, "names", "typed")
    counts = _name_counts(rows.union(others).select("names"))
    left = _prefixes(rows, counts, threshold, ["file", *order])
    right = _prefixes(others, counts, threshold, ["file", *order]).withColumnsRenamed(
        {"file": "base_file", "ord": "base_ord", "n": "base_n", "place": "base_place"}).drop("held")
    parts = F.ceil(F.col("held") / HELD_AT_ONCE)
    left = left.withColumn("part", F.pmod(F.xxhash64("file"), parts))
    shared = counts.select("name", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("held") / HELD_AT_ONCE) - 1)).alias("part"))
    right = right.join(shared, "name")
    both = F.col("n") + F.col("base_n")
    needed = F.ceil(F.round(both * F.lit(least / (1 + least)), 9))
    pairs = left.join(right, ["name", "part"]).filter(
        F.least(F.col("n") - F.col("place"), F.col("base_n") - F.col("base_place")) + F.least("place", "base_place") >= needed)
    if earlier:
        pairs = pairs.filter("base_ord < ord")
    pairs = pairs.select("file", "base_file").distinct()
    scored = pairs.join(rows.select("file", "names", "typed"), "file").join(
        others.select(F.col("file").alias("base_file"), F.col("names").alias("base_names"), F.col("typed").alias("base_typed")), "base_file")
    score = similarity(F.col("names"), F.col("base_names"), F.col("typed"), F.col("base_typed"))
    return scored.select("file", "base_file", score.alias("score")).filter(F.col("score") >= threshold)


def _first_leaders(rows: DataFrame, threshold: float) -> DataFrame:
    """Schemas that are the earliest with every name of their prefix: nothing earlier can be similar to them."""
    prefix = _prefixes(rows, _name_counts(rows), threshold, ["file", "ord"])
    earliest = prefix.groupBy("name").agg(F.min("ord").alias("least"))
    return prefix.join(earliest, "name").groupBy("file", "ord").agg(F.min(F.col("ord") == F.col("least")).alias("first")).filter("first")


def assign_leaders(singles: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Greedy similarity groups: (file, leader, score), the leader being the earliest similar one.

    The sequential rule takes schemas in ``ord`` order; the earliest one that is open leads and absorbs all similar ones.
    Here a schema leads as soon as every earlier similar one is known to follow, and follows as soon as an earlier
    similar one leads, for all schemas at once. First, rounds without pairs: a schema that is the earliest with each of
    its prefix names leads, and a name has one such schema at most, so what follows it shows in a join of bounded rows;
    groups of very many like schemas end here. Once such a round settles less than a quarter, pairs of the schemas left
    are listed, and rounds on these pairs settle the rest; there are as many as the longest chain of similar schemas.
    Every round is stored.
    """
    rows = cut(singles.select("file", "ord", "names", "typed"))
    # A schema without names is similar to none.
    leaders = [rows.filter(F.size("names") == 0).select("file", "ord")]
    left = rows.filter(F.size("names") > 0)
    number, before = left.count(), 0
    while number and (not before or (before - number) * 4 >= before):
        first = cut(_first_leaders(left, threshold).select("file", "ord"))
        leaders.append(first)
        near = similar_to(left.join(first, "file", "left_anti"), left.join(first.select("file"), "file"), threshold)
        gone = near.select("file").union(first.select("file")).distinct()
        left = cut(left.join(gone, "file", "left_anti"))
        number, before = left.count(), number
    if number:
        found = similar_to(left, left, threshold, earlier=True)
        edges = cut(found.select("file", "base_file"))
        nodes = left.select("file", "ord")
        while not nodes.isEmpty():
            lead = nodes.join(edges.select("file").distinct(), "file", "left_anti")
            leaders.append(lead := cut(lead))
            follow = edges.join(lead.select(F.col("file").alias("base_file")), "base_file", "left_semi").select("file")
            gone = cut(lead.select("file").union(follow).distinct())
            nodes = cut(nodes.join(gone, "file", "left_anti"))
            edges = cut(edges.join(gone, "file", "left_anti").join(gone.withColumnRenamed("file", "base_file"), "base_file", "left_anti"))
    chosen = cut(reduce(DataFrame.union, leaders))
    itself = chosen.select("file", F.col("file").alias("leader"), F.lit(1.0).alias("score"))
    bases = rows.join(chosen.select("file"), "file", "left_semi")
    near = similar_to(rows.join(chosen.select("file"), "file", "left_anti"), bases, threshold, earlier=True)
    ranked = near.join(chosen.select(F.col("file").alias("base_file"), F.col("ord").alias("base_ord")), "base_file")
    first = F.min(F.struct("base_ord", F.col("base_file").alias("leader"), "score")).alias("m")
    return ranked.groupBy("file").agg(first).select("file", "m.leader", "m.score").unionByName(itself)


def schema_groups(schemas: DataFrame, size: Column, threshold: float = THRESHOLD) -> DataFrame:
    """Assign every file to exactly one group of equal, similar or single schema.

    Output: file, group_name, reason, similarity (the least one to the base), recommended_name.
    """
    sized = schemas.select("*", size.alias("_mb"))
    heads = (
        sized.groupBy("fingerprint")
        .agg(F.count("*").alias("files"), F.min(F.struct("file", "names", "typed")).alias("first"))
        .select("fingerprint", "files", "first.*")
        .orderBy("file")
        .withColumn("ord", F.monotonically_increasing_id())
    )
    heads = cut(heads)
    exact = heads.filter("files > 1").select("ord", F.col("file").alias("leader"), F.lit(1.0).alias("least"), "files")
    assigned = assign_leaders(heads.filter("files = 1"), threshold)
    followers = assigned.groupBy("leader").agg(
        F.count("*").alias("files"), F.min(F.when(F.col("file") != F.col("leader"), F.col("score"))).alias("least")
    )
    led = followers.join(heads.select(F.col("file").alias("leader"), "ord"), "leader").select(
        "ord", "leader", F.coalesce("least", F.lit(1.0)).alias("least"), "files"
    )
    numbered_exact = number_rows(
        exact.withColumn("kind", F.lit("exact")), RowOrder(["kind"], ["ord"], F.col("ord")), "n"
    )
    offset = heads.filter("files > 1").count()
    kind = F.when(F.col("files") > 1, "similar").otherwise("single")
    numbered_led = number_rows(
        led.withColumn("kind", F.lit("led")), RowOrder(["kind"], ["ord"], F.col("ord")), "n"
    ).withColumns({"n": F.col("n") + offset, "kind": kind})
    groups = numbered_exact.unionByName(numbered_led)
    number = F.when(F.col("n") < 1000, F.lpad(F.col("n").cast("string"), 3, "0")).otherwise(F.col("n").cast("string"))
    stem = F.regexp_replace(F.substring_index("leader", "/", -1), r"(?<=.)\.[^.]*$", "")
    # Group names and reasons.
    forms = {
        "exact": (F.concat(F.lit("parquet_group_"), number, F.lit("_exact_match")), "Identical schema"),
        "similar": (F.concat(F.lit("parquet_group_"), number, F.lit("_similar_schema")), f"Similar schema (>= {threshold})"),
        "single": (F.concat(F.lit("individual_file_"), number), "Unique schema - convert individually"),
    }

    def by_kind(pick) -> Column:
        out = F.lit(None)
        for k, form in forms.items():
            out = F.when(F.col("kind") == k, pick(form)).otherwise(out)
        return out

    named = groups.select(
        "leader",
        by_kind(lambda f: f[0]).alias("group_name"),
        by_kind(lambda f: F.lit(f[1])).alias("reason"),
        F.col("least").alias("similarity"),
        F.concat(F.when(F.col("kind") == "single", stem).otherwise(by_kind(lambda f: f[0])), F.lit(".parquet")).alias(
            "recommended_name"
        ),
    )
    own = heads.select("fingerprint", "files", "file")
    led_by = own.join(assigned.select("file", "leader"), "file", "left").select(
        "fingerprint", F.coalesce("leader", "file").alias("leader")
    )
    return (
        sized.select("file", "fingerprint", "column_count", F.col("_mb").alias("size_mb"))
        .join(led_by, "fingerprint")
        .join(named, "leader")
        .drop("leader")
    )


def group_report(grouped: DataFrame) -> DataFrame:
    """One row per group of ``schema_groups``: files, size, least similarity."""
    return grouped.groupBy("group_name", "reason", "recommended_name", "similarity").agg(
        F.count("*").alias("total_files"),
        F.round(F.sum("size_mb"), 2).alias("total_size_mb"),
        F.min("file").alias("first_file"),
    )
