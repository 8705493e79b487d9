"""Question/response report sheets to one record per question, and their roll-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from gridloom.functions import entities as ent
from gridloom.functions.paths import base_name
from gridloom.operators.clean import or_default
from gridloom.operators.lineage import cut
from gridloom.operators.ordered import RowOrder, carry_forward, look_around, number_rows, running_sum
from gridloom.operators.rollup import conditional_counts, custom_rank

# Headings and labels of the report layout.
RISK_TYPES = ["Environmental", "Social", "Governance"]
ROW_LABELS = ["Question", "Response", "Industry Comparison", "Industry Average"]
SECTION_WORDS = [
    "Biodiversity", "Energy", "Climate", "Human Capital", "Employee Health", "Human Rights",
    "Ethics", "Corporate Governance", "Risk & Crisis", "Employment Practices",
]
METRIC_COLUMNS = {
    "biodiversity_metrics_count": "Biodiversity",
    "energy_metrics_count": "Energy",
    "climate_metrics_count": "Climate",
    "human_capital_metrics_count": "Human Capital",
    "employee_health_metrics_count": "Employee Health",
    "human_rights_metrics_count": "Human Rights",
    "ethics_metrics_count": "Ethics",
    "corporate_governance_metrics_count": "Corporate Governance",
    "risk_crisis_metrics_count": "Risk & Crisis",
    "employment_practices_metrics_count": "Employment Practices",
}
PLACEHOLDER_RISKS = ["Social", "Governance"]
DESCRIPTION_MARK = "S&P Global offers"
DEFAULT_DESCRIPTION = (
    "S&P Global offers a diverse range of sustainability measurements and workflow solutions. "
    "The themes are a selection of company specific measurements that are essential for measuring "
    "performance and progress on sustainability topics. The measurements are derived from a broad "
    "ecosystem of proprietary datasets that include corporate sustainability assessments (CSA), "
    "environmental and climate risk measurements."
)
RECORD_COLUMNS = [
    "company_name", "key", "description", "risk_type", "category", "question", "response",
    "industry_comparison", "industry_average", "source_file", "processed_timestamp",
]
SHEET = ["file_path", "sheet_no"]


def _cell(i: int) -> Column:
    return F.get("cells", F.lit(i))


def questions(rows: DataFrame) -> DataFrame:
    """Complete question blocks with the risk type and numbered category above them."""
    label = F.col("label")
    named = label.rlike("|".join(SECTION_WORDS)) & ~label.isin(RISK_TYPES + ROW_LABELS)
    lines = rows.select(*SHEET, "row_idx", _cell(0).alias("label"), _cell(1).alias("value"))
    flagged = lines.withColumns(
        {"risk": F.when(label.isin(RISK_TYPES), label), "section": F.when(named, label)}
    )
    by = RowOrder(SHEET, ["row_idx"], F.col("row_idx")).measured(flagged)
    sections = _numbered(flagged.filter("section is not null"), by)
    whole = flagged.filter("section is null").unionByName(sections)
    carried = carry_forward(whole, by, {"risk_type": F.col("risk"), "category": F.col("section")})

    def following(w: WindowSpec) -> dict[str, Column]:
        return {f"{c}{i}": F.lead(c, i).over(w) for i in (1, 2, 3) for c in ("label", "value")}

    blocks = look_around(carried, by, 0, 3, following)
    complete = label == ROW_LABELS[0]
    for i, wanted in enumerate(ROW_LABELS[1:], start=1):
        complete = complete & (F.col(f"label{i}") == wanted)
    return blocks.filter(complete).select(
        *SHEET,
        "row_idx",
        F.coalesce("risk_type", F.lit("Unknown")).alias("risk_type"),
        F.coalesce("category", F.lit("Unknown Category")).alias("category"),
        or_default(F.col("value"), "Unknown question").alias("question"),
        F.coalesce("value1", F.lit("")).alias("response"),
        F.coalesce("value2", F.lit("")).alias("industry_comparison"),
        F.coalesce("value3", F.lit("")).alias("industry_average"),
    )


def _numbered(sections: DataFrame, by: RowOrder) -> DataFrame:
    """Section names with their repeat number from the second on.

    A first use is numbered too when the sheet already had the name with something in parentheses.
    """
    section = F.col("section")
    stemmed = sections.withColumn("stem", F.substring_index("section", "(", 1))
    repeated = number_rows(stemmed, by.with_keys("section"), "repeat")
    marked = running_sum(repeated, by.with_keys("stem"), {"marked": F.when(section.contains("("), 1).otherwise(0)})
    number = F.when(F.col("repeat") > 1, F.col("repeat")).when(
        (F.col("marked") > 0) & (section == F.col("stem")), F.lit(1)
    )
    name = F.coalesce(F.concat("section", F.lit("("), number, F.lit(")")), "section")
    return marked.withColumn("section", name).drop("stem", "repeat", "marked")


def companies(rows: DataFrame) -> DataFrame:
    """Name, key and description per file: from titles, else the file name, else any likely cell."""
    cells = rows.filter("row_idx < 30").select("file_path", "row_idx", F.posexplode("cells").alias("pos", "cell"))
    place = F.struct("row_idx", "pos")
    cell, row = F.col("cell"), F.col("row_idx")
    coloned, piped, bracketed = cell.contains(":"), cell.contains(" | "), cell.contains("(")
    title = F.when((row < 20) & (piped | coloned), ent.split_title(ent.title_cell(cell)))
    keyed = F.when(coloned | bracketed, ent.keyed_cell(cell))
    likely = F.when((row < 20) & ent.looks_like_name(cell), F.trim(cell))
    about = F.when(row.between(5, 19) & cell.contains(DESCRIPTION_MARK), cell)

    def first(found: Column) -> Column:
        return F.min_by(found, F.when(found.isNotNull(), place))

    found = (
        cells.select("file_path", "row_idx", "pos", title.alias("t"), keyed.alias("k"), likely.alias("n"), about.alias("d"))
        .groupBy("file_path")
        .agg(
            first(F.col("t.name")).alias("title_name"),
            first(F.col("t.key")).alias("title_key"),
            first(F.col("k")).alias("k"),
            first(F.col("n")).alias("likely"),
            first(F.col("d")).alias("about"),
        )
    )
    file_name = base_name(F.col("file_path"))
    named = found.withColumns(
        {"vendor": ent.vendor_file_entity(file_name), "generic": ent.generic_file_entity(file_name)}
    )
    c = F.col
    complete = c("title_name").isNotNull() & c("title_key").isNotNull()
    vendor_done = c("title_key").isNull() & c("vendor.key").isNotNull()
    file_key = F.when(vendor_done, c("vendor.key")).otherwise(F.coalesce("generic.key", "title_key", "vendor.key"))
    file_name_found = F.coalesce("title_name", "vendor.name", F.when(~vendor_done, c("generic.name")))
    second = named.select(
        "file_path", "k", "likely", "about",
        F.when(complete, c("title_name")).otherwise(file_name_found).alias("name"),
        F.when(complete, c("title_key")).otherwise(file_key).alias("key"),
    )
    beside = F.when(c("key").isNull(), c("k.name"))
    return second.select(
        "file_path",
        F.coalesce("name", beside, "likely", F.lit("Unknown Company")).alias("company_name"),
        F.coalesce("key", "k.key", F.lit("")).alias("key"),
        F.coalesce("about", F.lit(DEFAULT_DESCRIPTION)).alias("description"),
    )


def records(rows: DataFrame, add_placeholders: bool = True) -> DataFrame:
    """Question records of the first sheets with company columns and lineage."""
    first_sheet = rows.filter("sheet_no = 0")
    company = cut(companies(first_sheet))
    asked = questions(first_sheet).join(company, "file_path")
    if add_placeholders:
        asked = cut(asked)
        have = asked.groupBy("file_path").agg(F.collect_set("risk_type").alias("have"))
        wanted = F.array(*[F.lit(r) for r in PLACEHOLDER_RISKS])
        lacking = company.join(have, "file_path", "left").withColumn(
            "risk_type", F.explode(F.array_except(wanted, F.coalesce("have", F.array().cast("array<string>"))))
        )
        blank = {c: F.lit("") for c in ("category", "question", "response", "industry_comparison", "industry_average")}
        filler = lacking.withColumn("row_idx", F.explode(F.sequence(F.lit(-4), F.lit(-1)))).withColumns(blank)
        asked = asked.unionByName(filler.drop("have"), allowMissingColumns=True)
    stamped = asked.withColumns(
        {"source_file": F.col("file_path"), "processed_timestamp": F.current_timestamp().cast("string")}
    )
    return stamped.select(*RECORD_COLUMNS, "row_idx")


def roll_up(recs: DataFrame, match: str = "exact") -> DataFrame:
    """Metric counts per company and risk type, ordered by company and risk rank."""
    counted = conditional_counts(
        recs,
        ["company_name", "key", "description", "risk_type"],
        "category",
        METRIC_COLUMNS,
        first=["source_file", "processed_timestamp"],
        order=["source_file", "row_idx"],
        match=match,
    ).withColumnRenamed("total_count", "total_metrics_count")
    return counted.orderBy("company_name", custom_rank(F.col("risk_type"), RISK_TYPES), "key")
