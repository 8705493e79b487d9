"""Sectioned customer/supplier sheets to two tables of relationships."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from gridloom.functions.entities import file_side, sided_file_company
from gridloom.functions.paths import base_name
from gridloom.operators.clean import conform, fill_blank, pseudo_data
from gridloom.operators.lineage import cut
from gridloom.operators.ordered import RowOrder, carry_forward, look_around

# Columns of the two outputs and of the sheets.
COMMON = ["Relationship Type", "Primary Industry", "Geography", "Start Date", "End Date"]
LIMITS = ["Min %", "Max %", "Min Value ($M)", "Max Value ($M)"]
MONEY = {
    "customer": ["Customer Revenue ($M)", "Customer Revenue (%)"],
    "supplier": ["Supplier Expense ($M)", "Supplier Expense (%)"],
}
KEY_COLUMN = {"customer": "Customer Name", "supplier": "Supplier Name"}
OUTPUT_COLUMNS = {
    "customer": [
        "Company Name", "Description", "Disclosed Information", "Customer Name", "Supplier Name", "Relationship Type",
        "Primary Industry", "Geography", "Start Date", "End Date", "Customer Revenue ($M)", "Customer Revenue (%)",
        "Min %", "Max %", "Min Value ($M)", "Max Value ($M)", "Source",
    ],
    "supplier": [
        "Company Name", "Description", "Disclosed Information", "Supplier Name", "Customer Name", "Relationship Type",
        "Primary Industry", "Geography", "Start Date", "End Date", "Supplier Expense ($M)", "Supplier Expense (%)",
        "Min %", "Max %", "Min Value ($M)", "Max Value ($M)", "Source",
    ],
}
SHEET_COLUMNS = ["Customer Name", "Supplier Name", *COMMON, *MONEY["customer"], *MONEY["supplier"], *LIMITS, "Source"]
ROUNDED = {*MONEY["customer"], *MONEY["supplier"], *LIMITS}
# Reasons of files without data.
NO_CUSTOMERS = "Customer data: No customer data found"
NO_SUPPLIERS = "Supplier data: No supplier data found"
NO_SIDE = "Cannot determine file type (missing '_Customers_' or '_Suppliers_' in filename)"
HEADER_REACH = 9
NO_DATA_REACH = 4
MARKER_REACH = 5
FALLBACK_HEADERS = 30
SHEET = ["file_path", "side", "sheet_no"]


def sided(rows: DataFrame) -> DataFrame:
    """Grid rows once per side named in the file name; files with neither side give no rows."""
    name = base_name(F.col("file_path"))
    sides = F.array_compact(
        F.array(
            F.when(name.contains("_Customers_"), F.lit("customer")),
            F.when(name.contains("_Suppliers_"), F.lit("supplier")),
        )
    )
    return rows.withColumn("side", F.explode(sides))


def _first_cell(word: str) -> Column:
    """First cell of a row holding a text, case ignored, trimmed."""
    return F.trim(F.get(F.filter("cells", lambda c: F.lower(c).contains(word)), F.lit(0)))


def _any_cell(test) -> Column:
    return F.coalesce(F.exists("cells", lambda c: F.coalesce(test(c), F.lit(False))), F.lit(False))


def _marked(rows: DataFrame) -> DataFrame:
    """Rows with their marker, header and notice flags and what surrounds them."""
    row = F.col("row_idx")
    key_term = F.concat("side", F.lit(" name"))
    key_column = F.when(F.col("side") == "customer", KEY_COLUMN["customer"]).otherwise(KEY_COLUMN["supplier"])
    about = F.trim(F.get(F.filter("cells", lambda c: c.contains("KEY:")), F.lit(0)))
    flagged = sided(rows).select(
        *SHEET,
        "row_idx",
        "cells",
        _first_cell("disclosed").alias("marker"),
        _any_cell(lambda c: F.lower(c).contains("no data available")).alias("no_data_available"),
        _any_cell(lambda c: F.lower(c).contains("no data")).alias("no_data"),
        _any_cell(lambda c: F.lower(c).contains(key_term)).alias("is_header"),
        _any_cell(lambda c: c == key_column).alias("is_exact_header"),
        about.alias("about"),
    )
    by = RowOrder(SHEET, ["row_idx"], row).measured(flagged)
    sheet_about = flagged.filter("about is not null").groupBy(*SHEET).agg(
        F.min("row_idx").alias("about_row"), F.min_by("about", "row_idx").alias("about_text")
    )

    def around(w: WindowSpec) -> dict[str, Column]:
        near = F.max("no_data_available").over(w.rowsBetween(1, NO_DATA_REACH))
        header_row = F.min(F.when(F.col("is_header"), row)).over(w.rowsBetween(1, HEADER_REACH))
        return {
            "empty_ahead": F.coalesce(near, F.lit(False)),
            "header_row": header_row,
            "no_data_next": F.coalesce(F.lead("no_data").over(w), F.lit(False)),
            "marker_before": F.first("marker", ignorenulls=True).over(w.rowsBetween(-MARKER_REACH, -1)),
        }

    seen = look_around(flagged, by, MARKER_REACH, HEADER_REACH, around)
    placed = carry_forward(seen, by, {"region": F.when(F.col("marker").isNotNull(), row)})
    return placed.drop("about").join(sheet_about, SHEET, "left")


def _named_cells(keys: list[str]) -> list[Column]:
    """The sheet's cells picked by the position of each known name in the header row."""

    def cell(name: str) -> Column:
        at = F.array_position("header", F.lit(name)).cast("int")
        text = F.when(at > 0, F.get("cells", at - 1))
        if name not in ROUNDED:
            return text.alias(name)
        number = F.round(text.try_cast("double"), 2)
        return F.when(number.isNotNull(), number.cast("string")).otherwise(text).alias(name)

    return [*[F.col(k) for k in keys], *[cell(n) for n in SHEET_COLUMNS]]


def _section_rows(marked: DataFrame) -> DataFrame:
    """Data rows of every section: below its header, above the next marker.

    A section whose next rows announce missing data is skipped. Sections that share a header all
    receive its rows. Rows and sections meet on the last marker at or above the header.
    """
    sections = marked.filter("marker is not null and not empty_ahead and header_row is not null").select(
        *SHEET,
        F.col("row_idx").alias("section_row"),
        F.col("marker").alias("section"),
        "header_row",
        F.when(F.col("about_row") < F.col("row_idx"), F.col("about_text")).otherwise("").alias("about"),
    )
    heads = marked.filter("is_header").select(
        *SHEET, F.col("row_idx").alias("header_row"), "region", F.col("cells").alias("header")
    )
    placed = sections.join(heads, [*SHEET, "header_row"])
    data = marked.select(*SHEET, "region", "row_idx", "cells")
    return data.join(placed, [*SHEET, "region"]).filter("row_idx > header_row")


def _direct_rows(marked: DataFrame) -> DataFrame:
    """Rows below each header among the first rows of a sheet, for sheets without sections."""
    usable = (F.col("row_idx") < FALLBACK_HEADERS) & F.col("is_exact_header") & ~F.col("no_data_next")
    heads = marked.filter(usable).select(
        *SHEET,
        F.col("row_idx").alias("header_row"),
        F.lit(-1).alias("section_row"),
        F.col("cells").alias("header"),
        F.coalesce("marker_before", F.lit("")).alias("section"),
        F.when(F.col("about_row") < F.col("row_idx"), F.col("about_text")).otherwise("").alias("about"),
    )
    return marked.select(*SHEET, "row_idx", "cells").join(heads, SHEET).filter("row_idx > header_row")


def _data_records(found: DataFrame, legacy: bool) -> DataFrame:
    keys = [*SHEET, "section_row", "header_row", "row_idx", "section", "about"]
    filled = found.filter(F.exists("cells", lambda c: c.isNotNull()))
    named = filled.select(*_named_cells(keys))
    key = F.when(F.col("side") == "customer", F.col("Customer Name")).otherwise(F.col("Supplier Name"))
    return named.filter(~pseudo_data(key, legacy))


def relationships(rows: DataFrame, legacy: bool = False) -> DataFrame:
    """Records of all sections; a file falls back to plain tables as far as sections gave nothing.

    Sheets are taken in order: the first sheet with a plain table wins if no earlier sheet, itself
    included, had section records; otherwise the section records stand.
    """
    marked = cut(_marked(rows))
    by_section = cut(_data_records(_section_rows(marked), legacy))
    file = ["file_path", "side"]
    first_section = by_section.groupBy(*file).agg(F.min("sheet_no").alias("section_sheet"))
    early = marked.join(first_section, file, "left").filter("section_sheet is null or sheet_no < section_sheet")
    direct = cut(_data_records(_direct_rows(early), legacy))
    first_direct = direct.groupBy(*file).agg(F.min(F.struct("sheet_no", "header_row")).alias("d"))
    choice = first_direct.select(*file, "d.sheet_no", "d.header_row")
    chosen = direct.join(choice, [*file, "sheet_no", "header_row"], "left_semi")
    kept = by_section.join(choice.select(*file), file, "left_anti")
    both = kept.unionByName(chosen)
    return both.withColumns(
        {
            "Company Name": sided_file_company(base_name(F.col("file_path"))),
            "Description": F.col("about"),
            "Disclosed Information": F.col("section"),
        }
    )


def output(records: DataFrame, side: str) -> DataFrame:
    """The 17 columns of one side, repeated rows removed before blanks are filled."""
    mine = records.filter(F.col("side") == side)
    return fill_blank(conform(mine, OUTPUT_COLUMNS[side]).distinct())


def outcomes(files: DataFrame, records: DataFrame, errors: DataFrame) -> DataFrame:
    """One row per file: status, reason, company and record counts.

    ``files`` and ``errors`` have a ``file_path``; errors also a ``reason``.
    """
    counts = records.groupBy("file_path").agg(
        F.count(F.when(F.col("side") == "customer", 1)).alias("customer_records"),
        F.count(F.when(F.col("side") == "supplier", 1)).alias("supplier_records"),
    )
    name = base_name(F.col("file_path"))
    read = errors.groupBy("file_path").agg(F.array_join(F.sort_array(F.collect_set("reason")), "; ").alias("problem"))
    joined = files.select("file_path").join(counts, "file_path", "left").join(read, "file_path", "left")
    neither = file_side(name).isNull()
    n = F.coalesce(F.col("customer_records") + F.col("supplier_records"), F.lit(0))
    missing = F.concat_ws(
        "; ",
        F.when(name.contains("_Customers_"), F.lit(NO_CUSTOMERS)),
        F.when(name.contains("_Suppliers_"), F.lit(NO_SUPPLIERS)),
    )
    return joined.select(
        "file_path",
        F.when(neither, "").otherwise(sided_file_company(name)).alias("company"),
        F.when(neither, "skip").when(F.col("problem").isNotNull(), "fail").when(n > 0, "success").otherwise("fail")
        .alias("status"),
        F.when(neither, NO_SIDE)
        .when(F.col("problem").isNull() & (n > 0), "")
        .otherwise(F.coalesce("problem", missing))
        .alias("reason"),
        F.coalesce("customer_records", F.lit(0)).alias("customer_records"),
        F.coalesce("supplier_records", F.lit(0)).alias("supplier_records"),
    )
