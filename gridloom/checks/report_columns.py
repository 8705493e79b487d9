"""The report jobs with every column that they put out, for both sides of sectioned sheets."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.checks.registry import query
from gridloom.checks.reports import ALL_PRODUCTS, PRODUCT_COUNT, RECORDS_SQL, laid_out, line, numbered_orders, question_grid, sheet_path
from gridloom.operators.lineage import cut
from gridloom.operators.ordered import RowOrder, number_rows
from gridloom.plans import question_report, screen_report, section_report

ALL_TYPES = "; ".join(t for t, subs in screen_report.DEFAULT_PRODUCTS.items() for _ in ["", *subs])


def described(sql: str) -> str:
    return sql.replace("'", "''")


@query(
    "q_question_columns",
    RECORDS_SQL
    + f"""select rec.*, '{described(question_report.DEFAULT_DESCRIPTION)}' as description, o_totalprice as industry_average,
      '/d/' || regexp_extract(key, 'MI KEY: ([0-9]+)', 1) || '.xlsx' as source_file, true as stamped
      from rec left join orders on response = 'r' || o_orderkey""",
)
def question_columns(t):
    found = question_report.records(question_grid(t))
    return found.select(*question_report.RECORD_COLUMNS).withColumns(
        {"industry_average": F.col("industry_average").try_cast("double"), "stamped": F.col("processed_timestamp").isNotNull()}
    ).drop("processed_timestamp")


def screen_sheet(t):
    orders = numbered_orders(t).join(t.customer.select("c_custkey", "c_acctbal"), "c_custkey")
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    key, status, text = F.col("o_orderkey"), F.col("o_orderstatus"), F.lit
    named = lambda letter, test: F.when(test, F.concat(text(letter), key))
    product = F.when(status == "F", "Tobacco").when(status == "O", "        Retail").otherwise("Gambling")
    total = F.when(key % 3 != 0, F.col("c_acctbal")).otherwise(F.lit(-1.5))
    body = laid_out(
        orders.join(counts, "c_custkey"),
        sheet_path(),
        [
            line(F.col("rn") + 10, F.col("o_orderpriority"), named("v", key % 2 == 0), named("p", key % 5 != 0), total,
                 F.when(key % 4 == 0, "-").otherwise(named("m", key > 0)), text("1"), text("2")),
            line(F.col("rn") + F.col("n") + 11, product, named("a", key % 2 == 0), named("b", key % 3 == 0), text("method"),
                 F.when(key % 4 == 0, screen_report.NONE).otherwise(named("c", key > 0)), named("d", key % 7 != 0),
                 F.when(key % 5 == 0, "").otherwise(named("e", key > 0)), text("doc"), text("all")),
        ],
    )
    heads = laid_out(
        t.customer.join(counts, "c_custkey"),
        sheet_path(),
        [
            line(text(0), F.concat("c_name", text(" | Screens"))),
            line(text(1), F.concat("c_name", text(" (MI KEY: "), "c_custkey", text("; SPCIQ KEY: 1)"))),
            line(text(2), text("Total Revenue (EUR M)"), F.col("c_acctbal")),
            line(text(3), text("Company Description")),
            line(text(4), F.concat(text("about "), "c_name")),
            line(text(5), text("Primary GICS Sub-Industry"), F.col("c_mktsegment")),
            line(text(6), text("Fiscal Year"), F.when(F.col("c_custkey") % 2 == 0, F.lit(2024))),
            line(text(7), text("Analysis Date"), text("2025-03-31")),
            line(text(8), text("Total Revenue Exposed (EUR M)"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey"))),
            line(text(9), text("Expansion Exposure"), text("No")),
            line(text(10), text("Business Involvement Screen Group"), text("Revenue")),
            line(F.col("n") + 11, text("Involvement Type"), text("a"), text("b")),
        ],
    )
    return cut(body.unionByName(heads))


def listed(value: str) -> str:
    return f"coalesce(string_agg({value}, '; ' order by o_orderkey), '')"


@query(
    "q_screen_columns",
    f"""with o as (select *, last_value(case o_orderstatus when 'F' then 'Tobacco' when 'P' then 'Gambling' end ignore nulls)
           over (partition by o_custkey order by o_orderkey rows between unbounded preceding and current row) as cat
           from orders join customer on c_custkey = o_custkey),
       b as (select o_custkey, count(*) as bis_count, {listed("o_orderpriority")} as bis_groups,
           {listed("case when o_orderkey % 2 = 0 then 'v' || o_orderkey end")} as bis_revenues,
           {listed("case when o_orderkey % 5 <> 0 then 'p' || o_orderkey end")} as bis_revenue_percentages,
           {listed("case when o_orderkey % 4 <> 0 then 'm' || o_orderkey end")} as bis_max_ownerships
         from o where o_orderkey % 3 <> 0 or abs(c_acctbal + 1.5) < 0.01 group by 1),
       p as (select o_custkey, count(*) as ps_count, {listed("cat")} as ps_involvement_types,
           {listed("case when o_orderstatus = 'O' then 'Retail' end")} as ps_subcategories,
           {listed("case when o_orderkey % 2 = 0 then 'a' || o_orderkey end")} as ps_revenues,
           {listed("case when o_orderkey % 3 = 0 then 'b' || o_orderkey end")} as ps_revenue_percentages,
           {listed("case when o_orderkey % 4 <> 0 then 'c' || o_orderkey end")} as ps_revenue_ranges,
           {listed("case when o_orderkey % 7 <> 0 then 'd' || o_orderkey end")} as ps_ownership_involvements,
           {listed("case when o_orderkey % 5 <> 0 then 'e' || o_orderkey end")} as ps_ownership_ranges
         from o where cat is not null group by 1)
       select c_name as name, c_name || ' (MI KEY: ' || c_custkey || '; SPCIQ KEY: 1)' as key, 'about ' || c_name as description,
         c_mktsegment as primary_gics_sub_industry, case when c_custkey % 2 = 0 then '2024' else '' end as fiscal_year,
         '2025-03-31' as analysis_date, 'EUR M' as currency, c_acctbal as total_revenue,
         case when c_custkey % 3 = 0 then cast(c_nationkey as varchar) else '0' end as total_revenue_exposed,
         '' as revenue_exposed_total_revenue_pct, 'No' as expansion_exposure,
         coalesce(bis_count, 0) as bis_count, coalesce(bis_groups, '') as bis_groups, coalesce(bis_revenues, '') as bis_revenues,
         coalesce(bis_revenue_percentages, '') as bis_revenue_percentages, coalesce(bis_max_ownerships, '') as bis_max_ownerships,
         coalesce(ps_count, {PRODUCT_COUNT}) as ps_count, coalesce(ps_involvement_types, '{ALL_TYPES}') as ps_involvement_types,
         coalesce(ps_subcategories, '{ALL_PRODUCTS}') as ps_subcategories, coalesce(ps_revenues, '') as ps_revenues,
         coalesce(ps_revenue_percentages, '') as ps_revenue_percentages, coalesce(ps_revenue_ranges, '') as ps_revenue_ranges,
         coalesce(ps_ownership_involvements, '') as ps_ownership_involvements, coalesce(ps_ownership_ranges, '') as ps_ownership_ranges
       from customer left join b on b.o_custkey = c_custkey left join p on p.o_custkey = c_custkey
       where c_custkey in (select o_custkey from orders)""",
)
def screen_columns(t):
    wide = screen_report.unified(screen_report.tables(screen_sheet(t)))
    return wide.withColumn("total_revenue", F.col("total_revenue").cast("double"))


def section_sheet(t, side: str):
    """One sheet a customer with all columns of a side: finished orders in the first section, the others in the second."""
    finished = F.col("o_orderstatus") == "F"
    orders = t.orders.withColumn("part", F.when(finished, 0).otherwise(1))
    placed = number_rows(orders, RowOrder(["o_custkey", "part"], ["o_orderkey"], F.col("o_orderkey")), "rn")
    counts = t.orders.groupBy("o_custkey").agg(F.count(F.when(finished, 1)).alias("m"), F.count("*").alias("n"))
    path = F.concat(F.lit("/d/P_C"), "o_custkey", F.lit(f"_{side.title()}s_1.xlsx"))
    key, price, text = F.col("o_orderkey"), F.col("o_totalprice"), F.lit
    other = section_report.KEY_COLUMN["supplier" if side == "customer" else "customer"]
    cells = {
        "Geography": F.when(key % 2 == 0, F.concat(text("G"), key)),
        section_report.KEY_COLUMN[side]: F.when(key % 5 == 0, F.concat(text("Name "), key)).otherwise(F.concat(text("Tournament "), key)),
        "Min %": price / 7, "Source": F.concat(text("src "), key), other: F.when(key % 3 == 0, F.concat(text("Other "), key)),
        "Primary Industry": F.concat(text("I"), "o_orderstatus"), "Relationship Type": F.col("o_orderpriority"),
        "Start Date": F.date_format("o_orderdate", "yyyy-MM-dd"), "End Date": text(None),
        section_report.MONEY[side][0]: price / 11, section_report.MONEY[side][1]: F.when(key % 7 == 0, "n/a").otherwise((key % 100).cast("string")),
        "Max %": text(None), "Max Value ($M)": text("-"), "Min Value ($M)": key,
    }
    at = F.when(F.col("part") == 0, F.col("rn") + 2).otherwise(F.col("m") + F.col("rn") + 4)
    body = laid_out(placed.join(counts, "o_custkey"), path, [line(at, *cells.values())])
    header = [text(name) for name in cells]
    heads = laid_out(
        t.customer.withColumn("o_custkey", F.col("c_custkey")).join(counts, "o_custkey"),
        path,
        [
            line(text(0), F.concat("c_name", text(" KEY: "), "c_custkey")),
            line(text(1), text("Disclosed Finished")),
            line(text(2), *header),
            line(F.col("m") + 3, text("Not Disclosed")),
            line(F.col("m") + 4, *header),
            F.when(F.col("c_custkey") % 4 == 0, line(F.col("n") + 5, text("No data available"))),
        ],
    )
    return cut(body.unionByName(heads))


#: Short names of the 17 columns of either side; those of the second list are compared as numbers.
NAMES = ["company", "description", "section", "name", "other_name", "relationship", "industry", "geography", "start_date", "end_date",
         "money", "money_pct", "min_pct", "max_pct", "min_value", "max_value", "source"]
NUMBERS = ["money", "min_pct", "min_value"]
SECTIONS_SQL = """with c as (select o_custkey, count(*) filter (o_orderstatus = 'F') as m, count(*) as n from orders group by 1),
         o as (select orders.*, c_name, c.m, c.n from orders join customer on c_custkey = o_custkey join c using (o_custkey)
           where o_orderkey % 5 <> 0),
         k as (select *, case when o_orderstatus = 'F' then 'Disclosed Finished' else 'Not Disclosed' end as section from o
           where o_custkey % 4 <> 0 or o_orderstatus = 'F' or n - m > 2),
         a as (select * from k union all select *, 'Disclosed Finished' from o where o_custkey not in (select o_custkey from k))
       select 'C' || o_custkey as company, c_name || ' KEY: ' || o_custkey as description, section, 'Tournament ' || o_orderkey as name,
         case when o_orderkey % 3 = 0 then 'Other ' || o_orderkey else '' end as other_name, o_orderpriority as relationship,
         'I' || o_orderstatus as industry, case when o_orderkey % 2 = 0 then 'G' || o_orderkey else '' end as geography,
         strftime(o_orderdate, '%Y-%m-%d') as start_date, '' as end_date, cast(round(o_totalprice / 11, 2) as double) as money,
         case when o_orderkey % 7 = 0 then 'n/a' else (o_orderkey % 100) || '.0' end as money_pct,
         cast(round(o_totalprice / 7, 2) as double) as min_pct, '' as max_pct, cast(o_orderkey as double) as min_value,
         '-' as max_value, 'src ' || o_orderkey as source from a"""


def section_columns(t, side: str):
    out = section_report.output(section_report.relationships(section_sheet(t, side)), side).toDF(*NAMES)
    return out.withColumns({n: F.col(n).cast("double") for n in NUMBERS})


@query("q_section_customers", SECTIONS_SQL)
def section_customers(t):
    return section_columns(t, "customer")


@query("q_section_suppliers", SECTIONS_SQL)
def section_suppliers(t):
    return section_columns(t, "supplier")
