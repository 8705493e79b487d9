"""Intake jobs: folder dedup, report jobs, typed loads and batch increments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from gridloom.functions.casts import infer_type, lenient_cast
from gridloom.functions.paths import base_name, table_from_dated_path, table_from_document
from gridloom.operators.clean import keyword_filter
from gridloom.operators.dedup import dedup_stats, distinct_rows, first_per_key
from gridloom.operators.ledger import unprocessed
from gridloom.operators.lineage import cut
from gridloom.operators.rollup import reduction
from gridloom.operators.schemas import catalog_of, schema_drift
from gridloom.plans import question_report, screen_report, section_report
from gridloom.plans.pool import Pool, run_lines
from gridloom.sources import manifest, writers
from gridloom.sources.folder import file_catalog, read_folder, read_list, read_schema_document, split_list
from gridloom.sources.workbook import grid_errors, grid_rows, read_grid

# Type names of schema documents by Spark type name.
DOCUMENT_TYPES = {
    "string": "STRING", "bigint": "INTEGER", "int": "INTEGER", "smallint": "INTEGER", "tinyint": "INTEGER",
    "double": "FLOAT64", "float": "FLOAT64", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}
LEDGER_SCHEMA = manifest.LEDGER_SCHEMA


def dedup_job(
    spark: SparkSession, source: str, target: str, subset: list[str] | None = None,
    tie_break: list[str] | None = None, fmt: str = "parquet", types: str = "infer",
) -> DataFrame:
    """Read a folder, drop repeated rows, write the rest and return the statistics.

    The united table is stored once for both; workbooks that cannot be read are listed in ``<target>_quarantine``.
    """
    table = cut(read_folder(spark, source, types, f"{target.rstrip('/')}_quarantine"))
    if subset:
        order = tie_break or [c for c in table.columns if c not in subset] or subset
        kept = first_per_key(table, subset, order)
    else:
        kept = distinct_rows(table)
    writers.write_format(kept, target, fmt)
    return dedup_stats(table, subset)


def staged_grid(spark: SparkSession, source: str, stage: str, all_sheets: bool = False) -> DataFrame:
    """Decode workbooks once into a table, so that the steps of a job share the decoded cells."""
    read_grid(spark, source, all_sheets).write.mode("overwrite").parquet(stage)
    return spark.read.parquet(stage)


def question_report_job(spark: SparkSession, source: str, target: str, roll_up_single: bool = False) -> DataFrame:
    """Question records and their roll-up from a folder of workbooks; returns the reduction figures."""
    grid = staged_grid(spark, source, f"{target}/_grid")
    writers.write_parquet(question_report.records(grid_rows(grid)), f"{target}/_records")
    recs = spark.read.parquet(f"{target}/_records")
    rolled = question_report.roll_up(recs)
    writers.write_csv(recs.select(*question_report.RECORD_COLUMNS), f"{target}/questions")
    writers.write_csv(rolled, f"{target}/consolidated", single=roll_up_single)
    writers.write_csv(grid_errors(grid), f"{target}/quarantine")
    return reduction(rolled, "total_metrics_count")


def screen_report_job(spark: SparkSession, source: str, target: str) -> list[str]:
    """Details, screens, products and the wide table from a folder of workbooks."""
    grid = staged_grid(spark, source, f"{target}/_grid")
    made = screen_report.tables(grid_rows(grid))
    stage = f"{target}/_tables"
    for name, table in vars(made).items():
        writers.write_parquet(table, f"{stage}/{name}")
    parts = screen_report.ScreenTables(*[spark.read.parquet(f"{stage}/{n}") for n in vars(made)])
    writers.write_csv(grid_errors(grid), f"{target}/quarantine")
    return writers.write_bundle({"unified": screen_report.unified(parts), **parts.plain()}, target)


def section_report_job(spark: SparkSession, source: str, target: str, legacy: bool = False) -> DataFrame:
    """Customer and supplier tables from a folder of workbooks; returns one outcome row per file."""
    grid = staged_grid(spark, source, f"{target}/_grid", all_sheets=True)
    found = section_report.relationships(grid_rows(grid), legacy)
    writers.write_parquet(found, f"{target}/_records")
    recs = spark.read.parquet(f"{target}/_records")
    for side in section_report.OUTPUT_COLUMNS:
        table = section_report.output(recs, side)
        if not table.isEmpty():
            writers.write_csv(table, f"{target}/{side}s", quote_all=True)
    files = file_catalog(spark, source, "*.[xX][lL][sS]*").select(F.col("path").alias("file_path"))
    done = section_report.outcomes(files, recs, grid_errors(grid))
    writers.write_csv(done, f"{target}/outcomes", quote_all=True)
    return done


def typed_columns(staging: DataFrame, document: list[tuple[str, str]], mode: str = "safe") -> DataFrame:
    """Cast staging columns to a schema document; extra text columns are kept, others refused.

    Both column lists are schema-sized, so they are compared before the plan is made.
    """
    by_name = {f.name.lower(): f for f in staging.schema.fields}
    wanted = {name.lower() for name, _ in document}
    extra = [f for n, f in sorted(by_name.items()) if n not in wanted]
    refused = [f"{f.name.lower()}({f.dataType.simpleString().upper()})" for f in extra if f.dataType.typeName() != "string"]
    if refused:
        raise ValueError("extra columns that are not STRING: " + ", ".join(refused))

    def cast(name: str, kind: str):
        field = by_name.get(name.lower())
        if field is None:
            return lenient_cast(F.lit(None).cast("string"), kind, mode=mode).alias(name)
        return lenient_cast(F.col(f"`{field.name}`"), kind, field.dataType, mode).alias(name)

    return staging.select(*[cast(n, k) for n, k in document], *[F.col(f"`{f.name}`") for f in extra])


def document_fields(document: DataFrame) -> list[tuple[str, str]]:
    return [(r["name"], r["type"]) for r in document.collect()]


def typed_load_job(
    spark: SparkSession, document_path: str, staging_paths: list[str], table: str, mode: str = "safe"
) -> int:
    """Load Parquet files into a typed table and return the row count read back from it."""
    document = document_fields(read_schema_document(spark, document_path))
    staging = spark.read.parquet(*staging_paths)
    return writers.create_typed_table(typed_columns(staging, document, mode), table)


def drift_job(spark: SparkSession, document: DataFrame, staging: DataFrame) -> DataFrame:
    """Expected and actual columns side by side."""
    actual = [(f.name, DOCUMENT_TYPES.get(f.dataType.simpleString(), "OTHER")) for f in staging.schema.fields]
    return schema_drift(document, spark.createDataFrame(actual, "name string, type string"))


def extract_schema_job(spark: SparkSession, paths: list[str], target: str, infer: bool = True) -> bool:
    """Write the schema document of Parquet files; an existing document is left alone."""
    try:
        if not spark.read.text(target).isEmpty():
            return False
    except AnalysisException:
        pass
    columns = catalog_of({"source": spark.read.parquet(*paths)})
    rows = [(o, n, DOCUMENT_TYPES.get(t, t.upper()), "NULLABLE") for _, o, n, t in columns]
    fields = spark.createDataFrame(rows, "ordinal int, name string, type string, mode string")
    if infer:
        fields = fields.withColumn("type", infer_type(F.col("name"), F.col("type")))
    field = F.struct("ordinal", F.struct("name", "type", "mode").alias("f"))
    listed = F.sort_array(F.collect_list(field))["f"]
    fields.agg(F.to_json(listed).alias("value")).write.mode("overwrite").text(target)
    return True


def load_list_job(spark: SparkSession, list_path: str, mode: str = "safe", pool: Pool = Pool()) -> DataFrame:
    """Typed loads for a list file of ``schema document,parquet path`` lines, several at a time; one outcome per line."""
    entries = split_list(read_list(spark, list_path), ["document", "source"])
    lines = entries.withColumn("table", table_from_document(F.col("document"))).toLocalIterator()

    def run(line) -> int:
        if not line["complete"]:
            raise ValueError(f"a field is missing in: {line['line']}")
        return typed_load_job(spark, line["document"], [line["source"]], line["table"], mode)

    return run_lines(spark, lines, run, pool)


def extract_list_job(spark: SparkSession, list_path: str, target: str, pool: Pool = Pool()) -> DataFrame:
    """Schema documents for a list file of Parquet paths, named after the paths; rows is 1 when written."""
    entries = read_list(spark, list_path)
    lines = entries.withColumn("table", table_from_dated_path(F.col("line"))).toLocalIterator()
    return run_lines(
        spark, lines, lambda line: int(extract_schema_job(spark, [line["line"]], f"{target}/{line['table']}")), pool
    )


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger table, empty before the first run."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], LEDGER_SCHEMA)


def pending_files(
    spark: SparkSession, source: str, ledger: DataFrame, keyword: str = "", extensions: list[str] = (), by: str = "path"
) -> DataFrame:
    """Files of a folder that match and are not recorded as done, by full path or by name."""
    files = file_catalog(spark, source)
    if extensions:
        files = files.filter(keyword_filter(F.col("name"), keyword, list(extensions)))
    done = ledger.filter("status = 'ok'")
    if by == "name":
        return unprocessed(files, done, F.col("name"), base_name(F.col("path")))
    return unprocessed(files, done, F.col("path"), F.col("path"))


def batch_increment(
    spark: SparkSession,
    source: str,
    ledger_path: str,
    process: Callable[[DataFrame], DataFrame],
    keyword: str = "",
    extensions: list[str] = (),
    by: str = "path",
) -> DataFrame:
    """List, leave out what is done, process, then record outcomes; failures come up again next run.

    ``process`` takes the pending files, writes its data and returns (path, status, reason). The
    ledger is appended only after that, so a lost run repeats rather than skips files.
    """
    pending = pending_files(spark, source, read_ledger(spark, ledger_path), keyword, extensions, by)
    outcome = process(pending).select("path", "status", "reason", F.current_timestamp().alias("processed_at"))
    outcome.write.mode("append").parquet(ledger_path)
    return read_ledger(spark, ledger_path)


def table_increment(
    spark: SparkSession,
    source: str,
    target: str,
    process: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    keyword: str = "",
    extensions: list[str] = (),
    by: str = "path",
) -> DataFrame:
    """Add the rows of all files that are new to a table, data and ledger in one commit; returns the ledger.

    ``process`` takes the pending files and returns their rows and (path, status, reason) of each. A run that breaks off
    anywhere leaves neither behind, so that repeating it adds every row once. Files that failed come up again.
    ``manifest.read_table`` reads the table. One run at a time is meant to write a table.
    """
    pending = cut(pending_files(spark, source, manifest.read_ledger(spark, target), keyword, extensions, by))
    if not pending.isEmpty():
        manifest.commit_run(spark, target, *process(pending))
    return manifest.read_ledger(spark, target)
