"""CSV files of many headers in one scan, with malformed lines set apart.

A first scan takes the header line of every file. The second reads every other line once, whatever its header: a
line's fields go to their columns by the positions that its file's header gives, so the plan depends on the number of
columns and not on the number of headers. Lines that cannot be read are kept beside the others with a reason and
counted on the way, without a pass of their own.

A record is a line: a line break inside quotes makes malformed lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.ledger import check_budget
from gridloom.operators.lineage import cut
from gridloom.sources.files import glob_of, scanned_path

#: Files up to which their headers' numbers are sent to every task; about 20 bytes each.
FILES_SENT = 1_000_000
#: Parts that the lines of a file are dealt into where there are more files.
SALTS = 32
# Text types tried in this order, the first that fits every value wins.
INFERRED = ["int", "bigint", "double", "boolean", "date", "timestamp"]
#: A comma and the field after it: quoted (\"\" and \\" are quotes inside), plain, or empty.
FIELD = r'(?s),(?:"(?:[^"\\]++|\\.|"")*+"(?=,|\z)|[^",][^,]*+|(?=,|\z))'
# Reasons of quarantine.
QUOTES, WIDE, SHORT = "quotes do not match", "more fields than the header", "fewer fields than the header"


def csv_headers(spark: SparkSession, path: str, glob: str = glob_of("csv")) -> DataFrame:
    """Header line of each CSV file: the first line of the file's first block that is not blank."""
    lines = (
        spark.read.option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .text(path)
        .select(
            "value",
            scanned_path().alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        )
    )
    filled = lines.filter("block = 0 and trim(value) <> ''")
    return filled.groupBy("path").agg(F.min_by("value", "line").alias("header"))


def data_lines(spark: SparkSession, path: str, glob: str = glob_of("csv")) -> DataFrame:
    """Every line of every CSV file but its header, which is told by its place and not by its text: path, value.

    Spark's own reader leaves out the header. No quotes and a separator that texts do not hold make a line one field; a
    line that does hold it comes back whole as well.
    """
    reader = spark.read.schema("value string, _whole string").option("header", True).option("recursiveFileLookup", True)
    reader = reader.option("sep", "\u0001").option("quote", "").option("escape", "\u0002").option("pathGlobFilter", glob)
    reader = reader.option("columnNameOfCorruptRecord", "_whole").option("enforceSchema", True)
    return reader.csv(path).select(scanned_path().alias("path"), F.coalesce("_whole", "value").alias("value"))


def fields_of(rows: DataFrame, line: str, name: str) -> DataFrame:
    """``rows`` with the fields of a line as an array, null where quotes do not match.

    An empty field is null, quotes around a field are taken off. Commas outside quotes part fields; which those are
    shows by counting quotes, in one pass. Only where a quote stands inside a plain field, which that count takes for
    an opening one, a pattern reads the line field by field.
    """
    text = F.col(line)
    marked = F.transform(F.split(F.replace(text, F.lit('\\"'), F.lit("\u0003")), '"', -1),
                         lambda part, i: F.when(i % 2 == 0, F.translate(part, ",", "\u0001")).otherwise(part))
    rows = rows.withColumn("_marked", F.when(text.contains('"'), marked))
    counted = F.split(F.array_join("_marked", '"'), "\u0001", -1)
    rows = rows.withColumn("_counted", F.when(F.size("_marked") % 2 == 1, F.transform(
        counted, lambda x: F.replace(x, F.lit("\u0003"), F.lit('\\"')))))
    fair = F.forall("_counted", lambda x: ~x.contains('"') | x.rlike(r'(?s)^".*"\z') & (F.length(x) > 1) | (
        ~x.startswith('"') & ~x.contains(",")))
    found = F.regexp_extract_all(F.concat(F.lit(","), text), F.lit(FIELD), F.lit(0))
    rows = rows.withColumn("_found", F.when(text.contains('"') & ~F.coalesce(fair & ~text.contains("\u0001"), F.lit(False)), found))
    read = F.when(F.length(F.array_join("_found", "")) == F.length(text) + 1, F.transform(
        "_found", lambda x: F.substring(x, 2, 2**31 - 1)))
    quoted = F.when(F.col("_found").isNull(), F.col("_counted")).otherwise(read)

    rows = rows.withColumn("_quoted", quoted).withColumn("_bare", F.expr(
        """transform(_quoted, x -> if(startswith(x, '"'),
           replace(replace(substring(x, 2, length(x) - 2), '""', '"'), '\\\\"', '"'), nullif(x, '')))"""))  # fmt: skip
    plain = F.transform(F.split(text, ",", -1), lambda x: F.nullif(x, F.lit("")))
    return rows.withColumn(name, F.when(~text.contains('"'), plain).otherwise(F.col("_bare"))).drop(
        "_marked", "_counted", "_found", "_quoted", "_bare")


def header_names(heads: DataFrame) -> DataFrame:
    """``heads`` (path, header) with the column names of the header: an empty one is named by its place, a repeated one
    gets its place behind it, letters count as equal in either case."""
    read = fields_of(heads.withColumn("_line", F.trim("header")), "_line", "_raw").drop("_line")
    raw = F.coalesce("_raw", F.array("header"))
    # A byte order mark belongs to no name.
    raw = F.transform(raw, lambda x, i: F.when(i == 0, F.ltrim(x, F.lit("\ufeff"))).otherwise(x))
    named = F.transform(raw, lambda x, i: F.coalesce(F.nullif(F.trim(x), F.lit("")), F.concat(F.lit("_c"), i.cast("string"))))
    rows = read.withColumn("_named", named).withColumn("_low", F.transform("_named", F.lower))
    repeats = F.transform("_named", lambda x, i: F.when(
        F.size(F.filter("_low", lambda y: y == F.lower(x))) > 1, F.concat(x, i.cast("string"))).otherwise(x))
    return rows.withColumn("names", repeats).drop("_raw", "_named", "_low")


@dataclass
class CsvScan:
    """What one scan of CSV files gives: rows by column name, lines that could not be read, and their numbers."""

    good: DataFrame
    #: file_path, record, reason.
    bad: DataFrame
    rows: int
    malformed: int


def scan_csv(spark: SparkSession, path: str, types: str = "infer", short: str = "pad", budget: int | None = None,
             glob: str = glob_of("csv"), source: str | None = None) -> CsvScan:
    """All CSV files of a folder and the folders below it as one table, columns united by name.

    A line with more fields than its header or with quotes that do not match is malformed; one with fewer is filled up
    with nulls, or malformed with ``short="quarantine"``. More malformed lines than ``budget`` are an error. Columns of
    ``types="infer"`` get the narrowest type that fits all values of all files, text otherwise. Empty lines are left
    out; a file with nothing but a header gives columns and no rows. Names differ in more than case; the spelling of
    the first path counts. ``source`` names a column for the path. Each byte is read twice.
    """
    heads = cut(header_names(csv_headers(spark, path, glob)))
    spelled = heads.select("path", F.explode("names").alias("name")).groupBy(F.lower("name").alias("low")).agg(
        F.min_by("name", F.struct("path", "name")).alias("name"))
    order = heads.select("path", F.posexplode("names").alias("at", "name")).groupBy(F.lower("name").alias("low")).agg(
        F.min(F.struct("path", "at")).alias("first"))
    # As many names as the united table has columns.
    columns = [r["name"] for r in spelled.join(order, "low").orderBy("first").collect()]
    if not columns:
        raise ValueError(f"no CSV file with a header in {path}")
    # Where each column of the table stands in a line, -1 where the header lacks it.
    at = F.transform(F.array(*[F.lit(c.lower()) for c in columns]), lambda c: F.array_position(F.transform("names", F.lower), c).cast("int") - 1)
    headers = cut(heads.groupBy("names").agg(F.min("path").alias("first")).withColumn("positions", at).withColumn(
        "number", F.xxhash64(F.array_join("names", "\u0000"))))
    by_file = cut(heads.select("path", F.xxhash64(F.array_join("names", "\u0000")).alias("number")))

    lines = data_lines(spark, path, glob)
    if by_file.count() <= FILES_SENT:
        lines = lines.join(F.broadcast(by_file), "path")
    else:
        lines = lines.withColumn("_salt", F.floor(F.rand(1) * SALTS).cast("int"))
        parts = by_file.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        lines = lines.join(parts, ["path", "_salt"]).drop("_salt")
    # One row a header, as wide as the table.
    lines = lines.join(F.broadcast(headers.select("number", "positions", F.size("names").alias("width"))), "number")
    read = fields_of(lines, "value", "fields")
    reason = F.when(F.col("fields").isNull(), QUOTES).when(F.size("fields") > F.col("width"), WIDE)
    if short == "quarantine":
        reason = reason.when(F.size("fields") < F.col("width"), SHORT)
    cells = F.transform("positions", lambda i: F.when(i >= 0, F.get(F.col("fields"), i)))
    read = read.withColumn("reason", reason).select(
        "path", "reason", F.when(F.col("reason").isNull(), cells).alias("cells"),
        F.when(F.col("reason").isNotNull(), F.col("value")).alias("record"))
    seen = Observation()
    stored = cut(read.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("reason").alias("malformed")))
    if budget is not None:
        check_budget(seen.get["malformed"], budget)

    cells = stored.filter("reason is null")
    kinds = inferred(cells, columns) if types == "infer" else ["string"] * len(columns)
    good = cells.select(
        *[F.col("path").alias(name) for name in [source] if name is not None],
        *[F.get("cells", F.lit(i)).cast(kind).alias(c) for i, (c, kind) in enumerate(zip(columns, kinds))])
    bad = stored.filter("reason is not null").select(F.col("path").alias("file_path"), "record", "reason")
    return CsvScan(good, bad, seen.get["rows"] - seen.get["malformed"], seen.get["malformed"])


def fitting(value: Column) -> Column:
    """The types of ``INFERRED`` that a text can be read as, a bit each."""
    fits = [value.try_cast(kind).isNotNull() for kind in INFERRED[:4]]
    dated = value.rlike("^[0-9]{4}-")
    fits += [dated & (F.length(value) <= 10) & value.try_cast("date").isNotNull(), dated & value.try_cast("timestamp").isNotNull()]
    total = sum((F.when(fit, 2**i).otherwise(0) for i, fit in enumerate(fits)), F.lit(0))
    return F.when(value.isNotNull(), total)


def inferred(rows: DataFrame, columns: list[str]) -> list[str]:
    """The narrowest type that fits all values of each column, from one pass over stored cells."""
    whole = rows.agg(*[F.bit_and(fitting(F.get("cells", F.lit(i)))).alias(f"c{i}") for i in range(len(columns))]).first()
    return [next((kind for i, kind in enumerate(INFERRED) if bits is not None and bits >> i & 1), "string") for bits in whole]
