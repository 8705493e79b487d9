"""Dedup, union, reconciliation, aggregates, joins and outcome tracking on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.checks.registry import query
from gridloom.operators import clean, dedup, ledger, recon, rollup
from gridloom.operators.ordered import RowOrder
from gridloom.operators.schemas import capped_count, column_profile

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
EVENT_TYPES = ["signup", "view", "click", "purchase", "error"]


@query("q_dedup_all", "select distinct text, lang from documents")
def dedup_all(t):
    return dedup.distinct_rows(t.documents.select("text", "lang"))


@query(
    "q_dedup_subset",
    """select doc_id, text, lang from (
         select *, row_number() over (partition by text order by doc_id) as rn from documents) where rn = 1""",
)
def dedup_subset(t):
    return dedup.first_per_key(t.documents.select("doc_id", "text", "lang"), ["text"], ["doc_id"])


@query(
    "q_dedup_stats",
    """select count(*) as original, count(distinct text) as kept, count(*) - count(distinct text) as removed,
         round((count(*) - count(distinct text)) * 100.0 / count(*), 2) as removed_pct from documents""",
)
def dedup_stats(t):
    return dedup.dedup_stats(t.documents.select("text"), ["text"])


@query(
    "q_union_by_name",
    """select c_custkey as id, c_name as name, c_mktsegment as segment, cast(null as double) as acctbal from customer
       union all select s_suppkey, s_name, null, s_acctbal from supplier""",
)
def union_by_name(t):
    left = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    right = t.supplier.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("acctbal")
    )
    return dedup.union_by_name([left, right])


@query(
    "q_union_mixed_types",
    """select cast(o_orderkey as varchar) as ref, o_totalprice as amount from orders
       union all select p_name, p_retailprice from part""",
)
def union_mixed_types(t):
    return dedup.union_by_name(
        [
            t.orders.select(F.col("o_orderkey").alias("ref"), F.col("o_totalprice").alias("amount")),
            t.part.select(F.col("p_name").alias("ref"), F.col("p_retailprice").alias("amount")),
        ]
    )


DIFF_SQL = """with l as (select o_custkey, count(*) as n from orders where o_orderstatus in ('F', 'P') group by 1),
  r as (select o_custkey, count(*) as n from orders where o_orderstatus in ('O', 'P') group by 1),
  d as (select coalesce(l.o_custkey, r.o_custkey) as o_custkey, coalesce(l.n, 0) as left_count,
          coalesce(r.n, 0) as right_count from l full outer join r on l.o_custkey = r.o_custkey),
  diff as (select *, greatest(left_count - right_count, 0) as left_only,
          greatest(right_count - left_count, 0) as right_only, least(left_count, right_count) as common from d)
"""


def order_diff(t):
    left = t.orders.filter("o_orderstatus in ('F', 'P')").select("o_custkey")
    right = t.orders.filter("o_orderstatus in ('O', 'P')").select("o_custkey")
    return recon.multiset_diff(left, right, ["o_custkey"])


@query("q_recon_diff", DIFF_SQL + "select * from diff")
def recon_diff(t):
    return order_diff(t)


@query(
    "q_recon_summary",
    DIFF_SQL
    + """select cast(sum(left_count) as bigint) as left_total, cast(sum(right_count) as bigint) as right_total,
      cast(sum(common) as bigint) as common_total, cast(sum(left_only) as bigint) as missing_in_right,
      cast(sum(right_only) as bigint) as missing_in_left from diff""",
)
def recon_summary(t):
    return recon.diff_summary(order_diff(t))


@query(
    "q_recon_report",
    DIFF_SQL
    + """, s as (select 'left_total' as value, sum(left_count) as copies from diff
        union all select 'right_total', sum(right_count) from diff union all select 'common_total', sum(common) from diff
        union all select 'missing_in_right', sum(left_only) from diff
        union all select 'missing_in_left', sum(right_only) from diff)
      select 'summary' as section, value, cast(copies as bigint) as copies from s
      union all select 'left', cast(o_custkey as varchar), left_count from diff where left_count > 0
      union all select 'right', cast(o_custkey as varchar), right_count from diff where right_count > 0
      union all select 'common', cast(o_custkey as varchar), common from diff where common > 0
      union all select 'missing_in_right', cast(o_custkey as varchar), left_only from diff where left_only > 0
      union all select 'missing_in_left', cast(o_custkey as varchar), right_only from diff where right_only > 0""",
)
def recon_report(t):
    return recon.diff_report(order_diff(t), "o_custkey")


@query(
    "q_recon_common_rows",
    """select o_custkey from (select o_custkey from orders where o_orderstatus in ('F', 'P')
       intersect all select o_custkey from orders where o_orderstatus in ('O', 'P'))""",
)
def recon_common_rows(t):
    return recon.expand_copies(order_diff(t).select("o_custkey", "common"), "common")


@query(
    "q_size_buckets",
    """with s as (select round(n_chars / 1024, 2) as s from documents)
       select count(*) as total_files, round(sum(s), 2) as total_size, count(*) filter (s < 1) as below,
         count(*) filter (s between 1 and 5) as between_, count(*) filter (s > 5) as above from s""".replace(
        "between_", '"between"'
    ),
)
def size_buckets(t):
    return recon.size_buckets(t.documents, F.round(F.col("n_chars") / 1024, 2), 1, 5)


@query(
    "q_cond_count",
    """select user_id, min(epoch_us(ts)) as first_us, count(*) filter (event_type = 'signup') as signup_count,
         count(*) filter (event_type = 'view') as view_count, count(*) filter (event_type = 'click') as click_count,
         count(*) filter (event_type = 'purchase') as purchase_count,
         count(*) filter (event_type = 'error') as error_count, count(*) as total_count from events group by 1""",
)
def cond_count(t):
    events = t.events.select("user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("first_us"))
    return rollup.conditional_counts(
        events, ["user_id"], "event_type", {f"{e}_count": e for e in EVENT_TYPES}, ["first_us"], ["first_us"]
    )


@query(
    "q_custom_order",
    """select user_id, event_type, count(*) as n, case event_type when 'signup' then 1 when 'view' then 2
         when 'click' then 3 else 4 end as rank from events group by user_id, event_type""",
)
def custom_order(t):
    counts = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    ranked = counts.withColumn("rank", rollup.custom_rank(F.col("event_type"), EVENT_TYPES[:3]))
    return ranked.orderBy("user_id", "rank", "event_type")


WIDE_SQL = """with c as (select l_orderkey, count(*) as item_count,
    coalesce(string_agg(l_returnflag, '; ' order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag)
      filter (l_returnflag <> 'N'), '') as flags,
    coalesce(string_agg(cast(l_suppkey as varchar), '; '
      order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag)
      filter (l_quantity > 25), '') as bulk_suppliers from lineitem group by 1)
  select o_orderkey, o_orderstatus, coalesce(item_count, 0) as item_count, coalesce(flags, '') as flags,
    coalesce(bulk_suppliers, '') as bulk_suppliers from orders left join c on o_orderkey = l_orderkey"""


@query("q_wide_summary", WIDE_SQL)
def wide_summary(t):
    items = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    order = RowOrder(
        ["o_orderkey"],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"],
        F.col("l_linenumber"),
    )
    lists = {
        "flags": F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")),
        "bulk_suppliers": F.when(F.col("l_quantity") > 25, F.col("l_suppkey").cast("string")),
    }
    parents = t.orders.select("o_orderkey", "o_orderstatus")
    return rollup.wide_summary(parents, items, "o_orderkey", order, lists, "item_count")


@query("q_ledger_anti", "select doc_id, lang from documents where doc_id not in (select doc_id from labels)")
def ledger_anti(t):
    return ledger.unprocessed(t.documents.select("doc_id", "lang"), t.labels, F.col("doc_id"), F.col("doc_id"))


@query(
    "q_ledger_update",
    "select doc_id from documents where lang = 'en' union select doc_id from labels",
)
def ledger_update(t):
    return ledger.ledger_with(t.labels.select("doc_id"), t.documents.filter("lang = 'en'").select("doc_id"))


@query("q_semi", "select n_nationkey, n_name from nation where n_nationkey in (select s_nationkey from supplier)")
def semi(t):
    nation, supplier = t.nation.select("n_nationkey", "n_name"), t.supplier
    return rollup.present(nation, supplier, nation["n_nationkey"] == supplier["s_nationkey"])


@query(
    "q_default_rows",
    """with p(priority, amount) as (values ('1-URGENT', '-'), ('2-HIGH', '-'), ('3-MEDIUM', '-'),
         ('4-NOT SPECIFIED', '-'), ('5-LOW', '-'))
       select c_custkey, c_name, priority, amount from customer, p where c_custkey not in (
         select o_custkey from orders where o_orderpriority = '1-URGENT' and o_totalprice > 300000)""",
)
def default_rows(t):
    urgent = t.orders.filter("o_orderpriority = '1-URGENT' and o_totalprice > 300000")
    return rollup.default_rows(
        t.customer.select("c_custkey", "c_name"),
        urgent.select(F.col("o_custkey").alias("c_custkey")),
        "c_custkey",
        [{"priority": p, "amount": "-"} for p in PRIORITIES],
    )


@query(
    "q_placeholders",
    """select c_custkey, '' as priority, cast(i as integer) as placeholder from customer, range(1, 5) r(i)
       where c_custkey not in (select o_custkey from orders where o_orderpriority = '3-MEDIUM')""",
)
def placeholders(t):
    medium = t.orders.filter("o_orderpriority = '3-MEDIUM'").select(F.col("o_custkey").alias("c_custkey"))
    customers = t.customer.select("c_custkey", F.lit("").alias("priority"))
    return rollup.placeholders(customers, medium, "c_custkey")


@query(
    "q_latest_run",
    """select event_id, strftime(ts, '%Y%m%d') as run_id from events
       where strftime(ts, '%Y%m%d') = (select max(strftime(ts, '%Y%m%d')) from events)""",
)
def latest_run(t):
    runs = t.events.select("event_id", F.date_format("ts", "yyyyMMdd").alias("run_id"))
    return recon.latest_run(runs, "run_id")


@query(
    "q_first_match",
    """select user_id, event_type, arg_min(value, ts) as first_value from events group by 1, 2""",
)
def first_match(t):
    return t.events.groupBy("user_id", "event_type").agg(F.min_by("value", F.struct("ts", "event_id")).alias("first_value"))


@query(
    "q_label_pivot",
    """select user_id, arg_min(value, ts) filter (event_type = 'signup') as signup_value,
         arg_min(value, ts) filter (event_type = 'purchase') as purchase_value,
         arg_max(value, ts) filter (event_type = 'error') as last_error_value from events group by 1""",
)
def label_pivot(t):
    labels = {"signup_value": "signup", "purchase_value": "purchase", "last_error_value": "error"}
    return rollup.first_values(
        t.events, ["user_id"], "event_type", F.col("value"), ["ts", "event_id"], labels, last=["last_error_value"]
    )


PROFILE_SQL = """with cells as (
    select 0 as src, c_custkey as id, 'c_name' as col, false as num, c_name as v, null::double as x from customer
    union all select 0, c_custkey, 'c_mktsegment', false, c_mktsegment, null from customer
    union all select 0, c_custkey, 'c_acctbal', true, cast(c_acctbal as varchar), c_acctbal from customer
    union all select 0, c_custkey, 'c_nationkey', true, cast(c_nationkey as varchar), c_nationkey from customer
    union all select 0, c_custkey, 'c_custkey', true, cast(c_custkey as varchar), c_custkey from customer
    union all select 1, s_suppkey, 's_name', false, s_name, null from supplier
    union all select 1, s_suppkey, 's_acctbal', true, cast(s_acctbal as varchar), s_acctbal from supplier
    union all select 1, s_suppkey, 's_nationkey', true, cast(s_nationkey as varchar), s_nationkey from supplier
    union all select 1, s_suppkey, 's_suppkey', true, cast(s_suppkey as varchar), s_suppkey from supplier),
  ranked as (select *, row_number() over (partition by col order by id) as p from cells where v is not null)
  select col as "column", count(*) as non_null_count, count(distinct v) as distinct_count,
    round(avg(length(v)) filter (not num), 4) as avg_length, max(length(v)) filter (not num) as max_length,
    min(x) as min_value, max(x) as max_value, round(avg(x), 4) as avg_value,
    string_agg(v, '; ' order by p) filter (p <= 3) as first_values from ranked group by col"""


@query("q_column_profile", PROFILE_SQL)
def profile(t):
    customers = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey"]
    suppliers = ["s_suppkey", "s_name", "s_acctbal", "s_nationkey"]
    return column_profile(t.customer, ["c_custkey"], customers, ["c_custkey"]).unionByName(
        column_profile(t.supplier, ["s_suppkey"], suppliers, ["s_suppkey"])
    )


@query(
    "q_head_per_group",
    """select user_id, event_id, event_type from (
         select *, row_number() over (partition by user_id order by ts, event_id) as rn from events) where rn <= 5""",
)
def head_per_group(t):
    events = t.events.select("user_id", "event_id", "event_type", "ts")
    return dedup.head_per_key(events, ["user_id"], ["ts", "event_id"], 5).drop("ts")


@query(
    "q_capped_count",
    "select user_id, least(count(*), 60) as rows, count(*) > 60 as more from events group by 1",
)
def capped(t):
    return capped_count(t.events, ["user_id"], 60)


@query(
    "q_reduction",
    """with g as (select user_id, event_type, count(*) as n from events group by 1, 2)
       select cast(sum(n) as bigint) as rows_in, count(*) as rows_out,
         round((sum(n) - count(*)) * 100.0 / sum(n), 2) as reduction_pct,
         round(sum(n) * 1.0 / count(*), 2) as ratio from g""",
)
def reduction(t):
    groups = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return rollup.reduction(groups, "n")


STATUS_SQL = """with s as (select *, case when event_type = 'error' then 'fail' when event_type = 'view' then 'skip'
    else 'success' end as status from events)"""


def statuses(t):
    kind = F.col("event_type")
    return t.events.withColumn(
        "status", F.when(kind == "error", "fail").when(kind == "view", "skip").otherwise("success")
    )


@query(
    "q_run_status",
    STATUS_SQL
    + """ select status, count(*) as files, cast(sum(cast(json_extract(props, '$.k') as bigint)) as bigint) as records
      from s group by 1""",
)
def run_status(t):
    return ledger.run_statistics(statuses(t), "status", F.get_json_object("props", "$.k").cast("long"))


@query(
    "q_completion",
    STATUS_SQL
    + """ select count(*) as total, count(*) filter (status <> 'fail') as done,
      count(*) filter (status <> 'fail') * 100 // count(*) as percent from s""",
)
def completion(t):
    return ledger.completion(statuses(t), F.col("status") != "fail")


@query(
    "q_failure_reasons",
    STATUS_SQL
    + """, r as (select distinct user_id, case when value > 10 then 'value too high' when value < 1 then 'value too low'
        else 'unknown' end as reason from s where status = 'fail')
      select user_id, string_agg(reason, '; ' order by reason) as reasons from r group by 1""",
)
def failure_reasons(t):
    value = F.col("value")
    reason = F.when(value > 10, "value too high").when(value < 1, "value too low").otherwise("unknown")
    failed = statuses(t).filter("status = 'fail'").select("user_id", reason.alias("reason"))
    return ledger.joined_reasons(failed, ["user_id"], "reason")


LOG_SQL = "replace(replace(replace(text, 'in', 'SUCCESS:'), 'er', 'SKIP:'), 'ou', 'ERROR:')"


@query(
    "q_log_counts",
    f"""with l as (select {LOG_SQL} as line from conversations)
       select count(*) filter (contains(line, 'SUCCESS:')) as successful, count(*) filter (contains(line, 'SKIP:')) as skipped,
         count(*) filter (contains(line, 'ERROR:')) as failed from l""",
)
def log_counts(t):
    lines = t.conversations.select(F.expr(LOG_SQL).alias("line"))
    markers = {"successful": "SUCCESS:", "skipped": "SKIP:", "failed": "ERROR:"}
    return ledger.marker_counts(lines, "line", markers)


@query(
    "q_quarantine",
    """with r as (select doc_id, case when n_chars < 200 then 'too short' when strpos(text, 'http') > 0 then 'has a link'
         end as reason from documents)
       select doc_id, reason, case when reason is null then 'ok' else 'quarantined' end as status from r""",
)
def quarantine(t):
    checks = {"too short": F.col("n_chars") < 200, "has a link": F.col("text").contains("http")}
    return ledger.quarantine(t.documents, checks).select("doc_id", "reason", "status")


@query(
    "q_top_n",
    """select o_orderkey, o_custkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 100""",
)
def top_n(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return dedup.top_rows(orders, [F.desc("o_totalprice"), "o_orderkey"], 100)


@query("q_sample", """select o_orderkey, o_totalprice from orders
    order by md5('42|' || o_orderkey::varchar), o_orderkey limit 500""")
def sample(t):
    return dedup.sample_above(t.orders.select("o_orderkey", "o_totalprice"), 500, ["o_orderkey"])


BLANKS_SQL = """with c as (select c_custkey as id, case when c_custkey % 7 = 0 then null when c_custkey % 5 = 0 then ''
    else c_name end as name, case when c_custkey % 7 = 0 then null else c_mktsegment end as segment from customer)"""


def blanked(t):
    key = F.col("c_custkey")
    return t.customer.select(
        key.alias("id"),
        F.when(key % 7 == 0, None).when(key % 5 == 0, "").otherwise(F.col("c_name")).alias("name"),
        F.when(key % 7 != 0, F.col("c_mktsegment")).alias("segment"),
    )


@query(
    "q_conform",
    BLANKS_SQL + """ select coalesce(segment, '') as segment, '' as region, coalesce(name, '') as name from c""",
)
def conform(t):
    return clean.fill_blank(clean.conform(blanked(t), ["segment", "region", "name"]))


@query(
    "q_all_string",
    """select cast(p_partkey as varchar) as p_partkey, p_name, cast(p_size as varchar) as p_size,
         case when p_size > 25 then null else p_brand end as p_brand from part""",
)
def all_string(t):
    part = t.part.select("p_partkey", "p_name", "p_size", F.when(F.col("p_size") <= 25, F.col("p_brand")).alias("p_brand"))
    return clean.all_string(part)


@query(
    "q_defaults",
    BLANKS_SQL
    + """ select id, coalesce(nullif(name, ''), '-') as name, coalesce(nullif(segment, ''), 'No Involvement') as segment,
      coalesce(nullif(name, ''), segment, '0') as fallback from c""",
)
def defaults(t):
    return blanked(t).select(
        "id",
        clean.or_default(F.col("name"), "-").alias("name"),
        clean.or_default(F.col("segment"), "No Involvement").alias("segment"),
        F.coalesce(clean.or_default(F.col("name"), F.col("segment")), F.lit("0")).alias("fallback"),
    )


@query(
    "q_constants",
    """select c_custkey, c_name, 'intake' as section, 'customer master' as description from customer""",
)
def constants(t):
    return clean.with_constants(
        t.customer.select("c_custkey", "c_name"), {"section": "intake", "description": "customer master"}
    )


@query(
    "q_round_listed",
    """select l_orderkey, l_linenumber, round(l_extendedprice / 7, 2) as price, round(l_quantity / 7, 2) as quantity,
         l_tax from lineitem""",
)
def round_listed(t):
    items = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") / 7).alias("price"),
        (F.col("l_quantity") / 7).alias("quantity"),
        "l_tax",
    )
    return clean.round_listed(items, ["price", "quantity", "absent"])


@query("q_drop_empty", BLANKS_SQL + " select * from c where name is not null or segment is not null")
def drop_empty(t):
    return clean.drop_empty_rows(blanked(t), ["name", "segment"])


PSEUDO_SQL = """with k as (select p_partkey, case when p_partkey % 11 = 0 then 'Not Disclosed ' || p_name
    when p_partkey % 7 = 0 then 'No Data for ' || p_name when p_partkey % 5 = 0 then 'The Name ' || p_name
    when p_partkey % 3 = 0 then 'Tournament ' || p_name when p_partkey % 13 = 0 then null else p_name end as k from part)"""


@query(
    "q_pseudo_rows",
    PSEUDO_SQL
    + r""" select p_partkey, k from k where k is not null and k <> ''
      and not regexp_matches(lower(k), 'disclosed|\bname\b|no data')""",
)
def pseudo_rows(t):
    key, name = F.col("p_partkey"), F.col("p_name")
    text = (
        F.when(key % 11 == 0, F.concat(F.lit("Not Disclosed "), name))
        .when(key % 7 == 0, F.concat(F.lit("No Data for "), name))
        .when(key % 5 == 0, F.concat(F.lit("The Name "), name))
        .when(key % 3 == 0, F.concat(F.lit("Tournament "), name))
        .when(key % 13 == 0, None)
        .otherwise(name)
    )
    keyed = t.part.select("p_partkey", text.alias("k"))
    return keyed.filter(~clean.pseudo_data(F.col("k")))


@query(
    "q_tolerant_equal",
    """with v as (select o_orderkey, cast(o_totalprice as varchar) as a, case when o_orderkey % 4 = 0
         then cast(o_totalprice + 0.005 as varchar) when o_orderkey % 4 = 1 then cast(o_totalprice + 0.02 as varchar)
         when o_orderkey % 4 = 2 then 'n/a' else cast(o_totalprice as varchar) end as b from orders)
       select o_orderkey, abs(try_cast(a as double) - try_cast(b as double)) < 0.01 is true or a = b as same from v""",
)
def tolerant_equal(t):
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    other = (
        F.when(key % 4 == 0, (price + 0.005).cast("string"))
        .when(key % 4 == 1, (price + 0.02).cast("string"))
        .when(key % 4 == 2, "n/a")
        .otherwise(price.cast("string"))
    )
    return t.orders.select("o_orderkey", clean.tolerant_equal(price.cast("string"), other).alias("same"))


@query("q_null_rows_kept", BLANKS_SQL + " select distinct name, segment from c")
def distinct_with_nulls(t):
    return dedup.distinct_rows(blanked(t).select("name", "segment"))
