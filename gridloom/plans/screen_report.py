"""Three-table report sheets to company details, screens, products and one wide table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.entities import DEFAULT_CURRENCY, currency
from gridloom.functions.paths import base_name
from gridloom.operators.clean import or_default, tolerant_equal
from gridloom.operators.lineage import cut
from gridloom.operators.ordered import RowOrder, carry_forward, look_around, ordered_concat, running_sum

# Labels of the report layout.
GROUP_HEADER = "Business Involvement Screen Group"
GROUPS_TITLE = "Business Involvement Screen Groups"
TYPE_HEADER = "Involvement Type"
LOCKED = "Further information is locked"
INDENT = "        "
NONE = "No Involvement"
EXPOSED_SHARE = "Revenue Exposed/ Total Revenue (%)"

# Screens assumed for a company without screen rows, with their maximum counts.
DEFAULT_SCREENS = {
    "Consumer Products & Services": "25",
    "Defense & Weapons": "25",
    "Energy & Fossil Fuels": "14",
    "Healthcare": "10",
}
SCREENS_THAT_END_PRODUCTS = ["Defense & Weapons", "Energy & Fossil Fuels", "Healthcare"]

# Involvement types and sub-types assumed for a company without product rows.
DEFAULT_PRODUCTS = {
    "Tobacco": ["Retail and Distribution", "Related Products and Services", "Production"],
    "Predatory Lending": ["Supporting Products and Services", "Operations"],
    "Pesticides": ["Production", "Retail"],
    "Palm Oil": ["Growers", "Processors and Traders"],
    "Genetically Modified Organisms": ["Development", "Growth"],
    "Gambling": ["Supporting Products and Services", "Operations", "Specialized Equipment"],
    "Fur and Specialty Leather": ["Retail and Distribution", "Production"],
    "Cannabis": ["Retail (Medical)", "Retail (Recreational)", "Wholesale (Medical)", "Wholesale (Recreational)"],
    "Animal Welfare": [
        "Household, Cosmetics and Personal Care Product Animal Testing",
        "Food and Beverage Animal Testing",
        "Chemicals Animal Testing",
        "Animal Testers and Breeders",
        "Animal Testing Suspected",
    ],
    "Alcohol": ["Retail and Distribution", "Related Products and Services", "Production"],
    "Adult Entertainment": ["Retail and Distribution", "Production"],
}
# What a product row without figures holds, and the columns of the three outputs.
PRODUCT_VALUES = {
    "revenue": "-",
    "revenue_exposed_total_revenue_pct": "-",
    "calculation_method": "-",
    "revenue_range": NONE,
    "ownership_involvement_pct": "-",
    "ownership_range": NONE,
    "source_document": "-",
    "all_sources": "-",
}
DETAIL_COLUMNS = [
    "name", "key", "description", "primary_gics_sub_industry", "fiscal_year", "analysis_date", "currency",
    "total_revenue", "total_revenue_exposed", "revenue_exposed_total_revenue_pct", "expansion_exposure",
]
SCREEN_COLUMNS = [
    "name", "key", "business_involvement_screen_group", "currency", "business_involvement_screen_revenue",
    "business_involvement_screen_revenue_pct", "total_revenue", "exclusionary_screen_maximum_ownership_pct",
    "exclusionary_screen_ownership_count_actual", "exclusionary_screen_max_ownership_count_actual",
]
PRODUCT_COLUMNS = ["name", "key", "involvement_type", "subcategory", "currency", *PRODUCT_VALUES]
LINEAGE = ["file_path", "row_idx"]


@dataclass(frozen=True)
class ScreenTables:
    details: DataFrame
    screens: DataFrame
    products: DataFrame

    def plain(self) -> dict[str, DataFrame]:
        return {
            "company_details": self.details.select(*DETAIL_COLUMNS),
            "business_involvement_screens": self.screens.select(*SCREEN_COLUMNS),
            "products_services": self.products.select(*PRODUCT_COLUMNS),
        }


def _grid(rows: DataFrame) -> tuple[DataFrame, RowOrder]:
    """First sheets with their first nine cells as columns and the labels one and two rows ahead, stored for all steps."""
    cells = [F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(9)]
    grid = rows.filter("sheet_no = 0").select("file_path", "row_idx", *cells)
    by = RowOrder(["file_path"], ["row_idx"], F.col("row_idx")).measured(grid)
    ahead = look_around(grid, by, 0, 2, lambda w: {f"ahead{i}": F.lead("c0", i).over(w) for i in (1, 2)})
    return cut(ahead), by


def _flag(test: Column) -> Column:
    return F.when(test, 1).otherwise(0)


def _details(grid: DataFrame) -> DataFrame:
    c0, c1, row = F.col("c0"), F.col("c1"), F.col("row_idx")

    def first(value: Column, test: Column) -> Column:
        return F.min_by(value, F.when(test, row))

    def last(test: Column, value: Column = c1) -> Column:
        return F.max_by(value, F.when(test, row))

    keyed = c0.contains("MI KEY:") & c0.contains("SPCIQ KEY:")
    revenue = c0.contains("Total Revenue") & ~c0.contains("Exposed") & c1.isNotNull()
    exposed = c0.contains("Total Revenue Exposed") & ~c0.isin(EXPOSED_SHARE)
    money = F.when(revenue | exposed, currency(c0))
    zero = F.coalesce(c1, F.lit("0"))
    found = grid.groupBy("file_path").agg(
        F.trim(first(F.substring_index(c0, "|", 1), c0.contains("|"))).alias("title"),
        F.trim(first(c0, keyed)).alias("raw_key"),
        first(F.col("ahead1"), c0 == "Company Description").alias("description"),
        last((c0 == "Primary GICS Sub-Industry") & c1.isNotNull()).alias("primary_gics_sub_industry"),
        last((c0 == "Fiscal Year") & c1.isNotNull()).alias("fiscal_year"),
        last((c0 == "Analysis Date") & c1.isNotNull()).alias("analysis_date"),
        first(money, money.isNotNull()).alias("money"),
        last(revenue).alias("total_revenue"),
        last(exposed, zero).alias("total_revenue_exposed"),
        last(c0 == EXPOSED_SHARE, zero).alias("revenue_exposed_total_revenue_pct"),
        last((c0 == "Expansion Exposure") & c1.isNotNull()).alias("expansion_exposure"),
    )
    before_paren = F.trim(F.substring_index("raw_key", "(", 1))
    name = F.coalesce(F.nullif("title", F.lit("")), F.nullif(before_paren, F.lit("")))
    whole = name.isNotNull() & (F.coalesce("raw_key", F.lit("")) != "")
    stem = F.regexp_replace(base_name(F.col("file_path")), r"(?<=.)\.[^.]*$", "")
    texts = [c for c in DETAIL_COLUMNS if c not in ("name", "key", "currency")]
    return found.select(
        "file_path",
        F.when(whole, name).otherwise(stem).alias("name"),
        F.when(whole, F.col("raw_key")).otherwise(F.lit("Unknown")).alias("key"),
        F.coalesce("money", F.lit(DEFAULT_CURRENCY)).alias("currency"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in texts],
    )


def _screens(grid: DataFrame, by: RowOrder, details: DataFrame) -> DataFrame:
    """Rows between the group header and the product header whose 4th cell is the total revenue."""
    company = details.select("file_path", "name", "key", "currency", F.col("total_revenue").alias("revenue_total"))
    c0 = F.col("c0")
    start = ((c0 == GROUP_HEADER) & F.col("c1").isNotNull()) | ((c0 == GROUPS_TITLE) & (F.col("ahead2") == GROUP_HEADER))
    data = tolerant_equal(F.col("c3"), F.col("revenue_total"))
    flagged = grid.join(company, "file_path").withColumns(
        {"header": F.coalesce(start, F.lit(False)), "data": F.coalesce(data, F.lit(False))}
    )
    started = running_sum(flagged, by, {"starts": _flag(F.col("header"))})
    stop = (F.col("starts") > 0) & (c0 == TYPE_HEADER) & ~F.col("header") & ~F.col("data")
    gated = running_sum(started, by, {"stops": _flag(stop)})
    kept = gated.filter("starts > 0 and stops = 0 and not header and data").filter(F.coalesce(c0, F.lit("")) != "")
    wanted = kept.select(
        *LINEAGE, "name", "key", c0.alias("business_involvement_screen_group"), "currency",
        or_default(F.col("c1"), "-").alias("business_involvement_screen_revenue"),
        or_default(F.col("c2"), "-").alias("business_involvement_screen_revenue_pct"),
        or_default(F.col("c3"), F.col("revenue_total")).alias("total_revenue"),
        or_default(F.col("c4"), "-").alias("exclusionary_screen_maximum_ownership_pct"),
        or_default(F.col("c5"), "0").alias("exclusionary_screen_ownership_count_actual"),
        or_default(F.col("c6"), "-").alias("exclusionary_screen_max_ownership_count_actual"),
    )
    found = cut(wanted)
    lone = company.join(found.select("file_path").distinct(), "file_path", "left_anti")
    named = grid.filter(c0.isin(list(DEFAULT_SCREENS))).select("file_path", c0.alias("screen")).distinct()
    places = {s: i for i, s in enumerate(DEFAULT_SCREENS)}
    filler = lone.join(named, "file_path").select(
        "file_path", _lookup(F.col("screen"), places).alias("row_idx"), "name", "key",
        F.col("screen").alias("business_involvement_screen_group"), "currency",
        F.lit("-").alias("business_involvement_screen_revenue"),
        F.lit("-").alias("business_involvement_screen_revenue_pct"),
        F.col("revenue_total").alias("total_revenue"),
        F.lit("-").alias("exclusionary_screen_maximum_ownership_pct"),
        F.lit("0").alias("exclusionary_screen_ownership_count_actual"),
        _lookup(F.col("screen"), DEFAULT_SCREENS).alias("exclusionary_screen_max_ownership_count_actual"),
    )
    return found.unionByName(filler)


def _lookup(value: Column, table: dict) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), value)


def _products(grid: DataFrame, by: RowOrder, details: DataFrame) -> DataFrame:
    """Category rows and their indented sub-types after the product header."""
    company = details.select("file_path", "name", "key", "currency")
    c0 = F.col("c0")
    header = (c0 == TYPE_HEADER) & F.col("c1").isNotNull() & F.col("c2").isNotNull()
    indented = c0.startswith(INDENT)
    flagged = grid.withColumn("header", F.coalesce(header, F.lit(False)))
    started = running_sum(flagged, by, {"starts": _flag(F.col("header"))})
    inside = (F.col("starts") > 0) & ~F.col("header") & (F.coalesce(c0, F.lit("")) != "")
    plain = inside & ~indented & ~c0.contains(LOCKED) & (c0 != GROUP_HEADER)
    marked = started.withColumns({"inside": inside, "own": F.when(plain, c0)})
    carried = carry_forward(marked, by, {"involvement_type": F.col("own")})
    counted = running_sum(carried, by, {"categories": _flag(F.col("own").isNotNull())})
    first = F.col("own").isNotNull() & (F.col("categories") == 1)
    ends = F.col("inside") & ((c0 == GROUP_HEADER) | (first & c0.isin(SCREENS_THAT_END_PRODUCTS)))
    gated = running_sum(counted, by, {"stops": _flag(ends)})
    entry = (
        F.col("inside")
        & (F.col("stops") == 0)
        & F.col("involvement_type").isNotNull()
        & (indented | F.col("own").isNotNull())
    )
    values = [
        or_default(F.col(f"c{i}"), default).alias(name)
        for i, (name, default) in enumerate(PRODUCT_VALUES.items(), start=1)
    ]
    found = cut(
        gated.filter(entry).select(
            *LINEAGE, "involvement_type", F.when(indented, F.trim(c0)).otherwise("").alias("subcategory"), *values
        )
    )
    lone = company.select("file_path").join(found.select("file_path").distinct(), "file_path", "left_anti")
    pairs = [(t, s) for t, subs in DEFAULT_PRODUCTS.items() for s in ["", *subs]]
    entries = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(s).alias("s")) for t, s in pairs])
    filler = lone.select("file_path", F.posexplode(entries).alias("row_idx", "e")).select(
        *LINEAGE,
        F.col("e.t").alias("involvement_type"),
        F.col("e.s").alias("subcategory"),
        *[F.lit(default).alias(name) for name, default in PRODUCT_VALUES.items()],
    )
    return found.unionByName(filler).join(company, "file_path").select(*LINEAGE, *PRODUCT_COLUMNS)


def tables(rows: DataFrame) -> ScreenTables:
    """The three tables of every report in a cell grid.

    Details are one row per file and feed both other tables; the found rows decide where defaults
    apply. The grid and both of these are cut so that the row-order steps run once.
    """
    grid, by = _grid(rows)
    details = cut(_details(grid))
    return ScreenTables(details, _screens(grid, by, details), _products(grid, by, details))


def unified(parts: ScreenTables) -> DataFrame:
    """One wide row per company with its screens and products counted and joined.

    Children belong to their company key, in path order and then row order; reports without a key stay apart, each by its own file,
    so that unidentified companies are not merged into one.
    """

    def owner(df: DataFrame) -> DataFrame:
        return df.withColumn("owner", F.when(F.col("key") == "Unknown", F.col("file_path")).otherwise(F.col("key")))

    def kept(column: str, nothing: str = "-") -> Column:
        return F.when((F.col(column) != "") & (F.col(column) != nothing), F.col(column))

    files = parts.details.select("file_path").orderBy("file_path")
    files = cut(files.withColumn("file_no", F.monotonically_increasing_id()))
    order = RowOrder(["owner"], ["file_no", "row_idx"], F.col("file_no"))
    screens = owner(parts.screens).join(files, "file_path")
    products = owner(parts.products).join(files, "file_path")
    screen_lists = ordered_concat(
        screens,
        order,
        {
            "bis_groups": kept("business_involvement_screen_group", ""),
            "bis_revenues": kept("business_involvement_screen_revenue"),
            "bis_revenue_percentages": kept("business_involvement_screen_revenue_pct"),
            "bis_max_ownerships": kept("exclusionary_screen_maximum_ownership_pct"),
        },
    ).withColumnRenamed("row_count", "bis_count")
    product_lists = ordered_concat(
        products,
        order,
        {
            "ps_involvement_types": kept("involvement_type", ""),
            "ps_subcategories": kept("subcategory", ""),
            "ps_revenues": kept("revenue"),
            "ps_revenue_percentages": kept("revenue_exposed_total_revenue_pct"),
            "ps_revenue_ranges": kept("revenue_range", NONE),
            "ps_ownership_involvements": kept("ownership_involvement_pct"),
            "ps_ownership_ranges": kept("ownership_range", NONE),
        },
    ).withColumnRenamed("row_count", "ps_count")
    wide = owner(parts.details).join(screen_lists, "owner", "left").join(product_lists, "owner", "left")
    lists = [c for c in wide.columns if c.startswith(("bis_", "ps_"))]
    filled = {c: F.coalesce(c, F.lit(0) if c.endswith("_count") else F.lit("")) for c in lists}
    return wide.withColumns(filled).select(*DETAIL_COLUMNS, *lists)
