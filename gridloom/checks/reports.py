"""Report jobs on cell grids that Spark lays out from customers and their orders.

Every customer is one sheet; a customer's orders become blocks of rows in order-key order. The grid
is cut from its lineage as a job's decoded and staged grid would be.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.checks.registry import query
from gridloom.operators.lineage import cut
from gridloom.operators.ordered import RowOrder, number_rows
from gridloom.plans import question_report, screen_report, section_report
from gridloom.plans.intake import typed_columns


def numbered_orders(t, keys=("o_custkey",)):
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    by = RowOrder(list(keys), ["o_orderkey"], F.col("o_orderkey"))
    return number_rows(orders, by, "rn").withColumnRenamed("o_custkey", "c_custkey")


def line(row, *cells):
    return F.struct(row.cast("int").alias("row_idx"), F.array(*[c.cast("string") for c in cells]).alias("cells"))


def laid_out(df, path, lines):
    """One grid row per line of each input row."""
    spread = df.select(path.alias("file_path"), F.explode(F.array_compact(F.array(*lines))).alias("l"))
    return spread.select("file_path", F.lit(0).alias("sheet_no"), F.lit("S").alias("sheet"), "l.*")


def sheet_path():
    return F.concat(F.lit("/d/"), "c_custkey", F.lit(".xlsx"))


def question_grid(t):
    key = F.col("o_orderkey")
    top = (F.col("rn") - 1) * 6
    status, rank = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    risk = F.when(status == "F", "Environmental").when(status == "O", "Social").otherwise("Governance")
    section = F.when(rank == "1", "Climate").when(rank == "2", "Energy").when(rank == "3", "Climate(x)").when(rank == "4", "Ethics")
    text = F.lit
    body = laid_out(
        numbered_orders(t),
        sheet_path(),
        [
            line(top + 1, risk),
            line(top + 2, section),
            line(top + 3, text("Question"), F.when(key % 10 != 0, F.concat(text("q"), key))),
            line(top + 4, F.when(key % 7 == 0, "Reply").otherwise("Response"), F.concat(text("r"), key)),
            line(top + 5, text("Industry Comparison"), F.concat(text("c"), key)),
            line(top + 6, text("Industry Average"), F.col("o_totalprice")),
        ],
    )
    title = F.concat("c_name", F.lit(" NYSE:AB"), "c_custkey", F.lit(" (old) (MI KEY: "), "c_custkey", F.lit(") | Overview"))
    return cut(body.unionByName(laid_out(t.customer, sheet_path(), [line(F.lit(0), title)])))


RECORDS_SQL = """with o as (select *, row_number() over (partition by o_custkey order by o_orderkey) as rn,
    case o_orderstatus when 'F' then 'Environmental' when 'O' then 'Social' else 'Governance' end as risk_type,
    case left(o_orderpriority, 1) when '1' then 'Climate' when '2' then 'Energy' when '3' then 'Climate(x)' when '4' then 'Ethics'
    end as section from orders),
  n as (select *, row_number() over (partition by o_custkey, section order by o_orderkey) as rep,
    count(*) filter (section = 'Climate(x)') over (partition by o_custkey order by o_orderkey) as marked from o),
  m as (select *, case when section is null then null when rep > 1 then section || '(' || rep || ')'
    when section = 'Climate' and marked > 0 then 'Climate(1)' else section end as numbered from n),
  f as (select *, coalesce(last_value(numbered ignore nulls) over (partition by o_custkey order by o_orderkey
    rows between unbounded preceding and current row), 'Unknown Category') as category from m),
  data as (select o_custkey, risk_type, category, case when o_orderkey % 10 = 0 then 'Unknown question' else 'q' || o_orderkey end as question,
    'r' || o_orderkey as response, 'c' || o_orderkey as industry_comparison from f where o_orderkey % 7 <> 0),
  blanks as (select c_custkey, risk, '' as category, '' as question, '' as response, '' as industry_comparison
    from customer, (values ('Social'), ('Governance')) r(risk), range(4) where not exists
      (select 1 from data where data.o_custkey = c_custkey and data.risk_type = risk)),
  a as (select * from data union all select * from blanks),
  rec as (select c_name as company_name, 'NYSE:AB' || c_custkey || ' (MI KEY: ' || c_custkey || ')' as key, a.* exclude (o_custkey)
    from a join customer on c_custkey = a.o_custkey)
"""


@query("q_question_report", RECORDS_SQL + "select * from rec")
def question_records(t):
    columns = ["company_name", "key", "risk_type", "category", "question", "response", "industry_comparison"]
    return question_report.records(question_grid(t)).select(*columns)


@query(
    "q_question_rollup",
    RECORDS_SQL
    + """select key, risk_type, count(*) filter (category = 'Climate') as climate_metrics_count,
      count(*) filter (category = 'Energy') as energy_metrics_count, count(*) filter (category = 'Ethics') as ethics_metrics_count,
      count(*) as total_metrics_count from rec group by 1, 2""",
)
def question_rollup(t):
    columns = ["key", "risk_type", *[f"{c}_metrics_count" for c in ("climate", "energy", "ethics", "total")]]
    return question_report.roll_up(question_report.records(question_grid(t))).select(*columns)


def screen_grid(t):
    orders = numbered_orders(t).join(t.customer.select("c_custkey", "c_acctbal"), "c_custkey")
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    placed = orders.join(counts, "c_custkey")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    product = F.when(status == "F", "Tobacco").when(status == "O", "        Retail").otherwise("Gambling")
    total = F.when(key % 3 != 0, F.col("c_acctbal")).otherwise(F.lit(-1.5))
    body = laid_out(
        placed,
        sheet_path(),
        [
            line(F.col("rn") + 3, F.col("o_orderpriority"), F.col("o_totalprice"), F.lit(None), total),
            line(F.col("rn") + F.col("n") + 4, product, F.when(key % 2 == 0, key)),
        ],
    )
    text = F.lit
    heads = laid_out(
        t.customer.join(counts, "c_custkey"),
        sheet_path(),
        [
            line(text(0), F.concat("c_name", text(" | Screens"))),
            line(text(1), F.concat("c_name", text(" (MI KEY: "), "c_custkey", text("; SPCIQ KEY: 1)"))),
            line(text(2), text("Total Revenue (EUR M)"), F.col("c_acctbal")),
            line(text(3), text("Business Involvement Screen Group"), text("Revenue")),
            line(F.col("n") + 4, text("Involvement Type"), text("a"), text("b")),
        ],
    )
    return cut(body.unionByName(heads))


ALL_PRODUCTS = "; ".join(s for subs in screen_report.DEFAULT_PRODUCTS.values() for s in subs)
PRODUCT_COUNT = sum(1 + len(subs) for subs in screen_report.DEFAULT_PRODUCTS.values())


@query(
    "q_screen_report",
    f"""with o as (select *, last_value(case o_orderstatus when 'F' then 'Tobacco' when 'P' then 'Gambling' end ignore nulls)
           over (partition by o_custkey order by o_orderkey rows between unbounded preceding and current row) as cat
           from orders join customer on c_custkey = o_custkey),
       b as (select o_custkey, count(*) as bis_count, string_agg(o_orderpriority, '; ' order by o_orderkey) as bis_groups from o
         where o_orderkey % 3 <> 0 or abs(c_acctbal + 1.5) < 0.01 group by 1),
       p as (select o_custkey, count(*) as ps_count, string_agg(case when o_orderstatus = 'O' then 'Retail' end, '; ' order by o_orderkey)
           as ps_subcategories, string_agg(case when o_orderkey % 2 = 0 then cast(o_orderkey as varchar) end, '; ' order by o_orderkey)
           as ps_revenues from o where cat is not null group by 1)
       select c_name as name, c_name || ' (MI KEY: ' || c_custkey || '; SPCIQ KEY: 1)' as key, 'EUR M' as currency,
         coalesce(bis_count, 0) as bis_count, coalesce(bis_groups, '') as bis_groups, coalesce(ps_count, {PRODUCT_COUNT}) as ps_count,
         case when p.o_custkey is null then '{ALL_PRODUCTS}' else coalesce(ps_subcategories, '') end as ps_subcategories,
         coalesce(ps_revenues, '') as ps_revenues
       from customer left join b on b.o_custkey = c_custkey left join p on p.o_custkey = c_custkey
       where c_custkey in (select o_custkey from orders)""",
)
def screens(t):
    wide = screen_report.unified(screen_report.tables(screen_grid(t)))
    return wide.select("name", "key", "currency", "bis_count", "bis_groups", "ps_count", "ps_subcategories", "ps_revenues")


def section_grid(t):
    finished = F.col("o_orderstatus") == "F"
    orders = t.orders.withColumn("part", F.when(finished, 0).otherwise(1))
    by = RowOrder(["o_custkey", "part"], ["o_orderkey"], F.col("o_orderkey"))
    placed = number_rows(orders, by, "rn").withColumnRenamed("o_custkey", "c_custkey")
    counts = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.when(finished, 1)).alias("m"), F.count("*").alias("n")
    )
    path = F.concat(F.lit("/d/P_C"), "c_custkey", F.lit("_Customers_1.xlsx"))
    key, text = F.col("o_orderkey"), F.lit
    name = F.when(key % 5 == 0, F.concat(text("Name "), key)).otherwise(F.concat(text("Tournament "), key))
    at = F.when(F.col("part") == 0, F.col("rn") + 2).otherwise(F.col("m") + F.col("rn") + 4)
    body = laid_out(placed.join(counts, "c_custkey"), path, [line(at, text(None), name, F.col("o_totalprice") / 7)])
    header = [text("Geography"), text("Customer Name"), text("Min %")]
    heads = laid_out(
        t.customer.join(counts, "c_custkey"),
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


@query(
    "q_section_report",
    """with c as (select o_custkey, count(*) filter (o_orderstatus = 'F') as m, count(*) as n from orders group by 1),
         o as (select orders.*, c_name, c.m, c.n from orders join customer on c_custkey = o_custkey join c using (o_custkey)
           where o_orderkey % 5 <> 0),
         k as (select *, case when o_orderstatus = 'F' then 'Disclosed Finished' else 'Not Disclosed' end as section from o
           where o_custkey % 4 <> 0 or o_orderstatus = 'F' or n - m > 2),
         a as (select * from k union all select *, 'Disclosed Finished' from o where o_custkey not in (select o_custkey from k))
       select 'C' || o_custkey as company, c_name || ' KEY: ' || o_custkey as description, section,
         'Tournament ' || o_orderkey as customer, cast(round(o_totalprice / 7, 2) as double) as min_pct from a""",
)
def sections(t):
    out = section_report.output(section_report.relationships(section_grid(t)), "customer")
    return out.select(
        F.col("Company Name").alias("company"),
        F.col("Description").alias("description"),
        F.col("Disclosed Information").alias("section"),
        F.col("Customer Name").alias("customer"),
        F.col("Min %").cast("double").alias("min_pct"),
    )


@query(
    "q_typed_load",
    """select o_orderkey as id, o_totalprice as amount, o_orderstatus in ('F', 'N') is not true as open_flag,
         strftime(o_orderdate, '%Y-%m-%d') as ordered, cast(null as bigint) as absent, o_orderpriority as priority from orders""",
)
def typed_load(t):
    staging = t.orders.select(
        F.concat(F.lit("#"), "o_orderkey").alias("ID"),
        F.concat(F.lit("$"), "o_totalprice").alias("Amount"),
        F.when(F.col("o_orderstatus") == "F", "no").otherwise("yes").alias("open_flag"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("ordered"),
        F.col("o_orderpriority").alias("priority"),
    )
    document = [("id", "INTEGER"), ("amount", "FLOAT64"), ("open_flag", "BOOL"), ("ordered", "DATE"), ("absent", "INT64")]
    typed = typed_columns(staging, document, mode="legacy")
    return typed.withColumn("ordered", F.col("ordered").cast("string"))
