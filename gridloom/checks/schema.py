"""Schema operators. Each customer stands for a file, its order priorities for the columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.checks.registry import query
from gridloom.functions.casts import infer_type, type_bucket
from gridloom.functions.names import sanitize, schema_name, snake, uniquify
from gridloom.operators import schemas

STATUS_TYPES = {"F": "int", "O": "varchar(20)", "P": "date"}

CATALOG_SQL = """with cat as (select 'f' || o_custkey as file, cast(left(o_orderpriority, 1) as integer) as ordinal,
    o_orderpriority as col, case min(o_orderstatus) when 'F' then 'int' when 'O' then 'varchar(20)' else 'date' end as type
    from orders group by o_custkey, o_orderpriority),
  b as (select *, case type when 'int' then 'integer' when 'date' then 'date' else 'string' end as bucket from cat),
  sch as (select file, md5(string_agg(regexp_replace(trim(lower(col)), '[^a-zA-Z0-9]', '_', 'g') || ':' || bucket, '|'
      order by regexp_replace(trim(lower(col)), '[^a-zA-Z0-9]', '_', 'g') || ':' || bucket)) as fingerprint,
    count(*) as column_count, list_sort(list(distinct col)) as names, list_sort(list(distinct col || ':' || bucket)) as typed
    from b group by file),
  sz as (select 'f' || o_custkey as file, round(sum(o_totalprice) / 1048576, 4) as mb from orders group by 1)
"""
SCORE_SQL = """round(len(list_intersect(a.names, b.names)) * 1.0
    / (len(a.names) + len(b.names) - len(list_intersect(a.names, b.names))) * 0.7
    + coalesce(len(list_intersect(a.typed, b.typed)) * 1.0 / nullif(len(list_intersect(a.names, b.names)), 0), 0) * 0.3, 9)"""


def catalog(t):
    kind = F.col("status")
    return (
        t.orders.groupBy("o_custkey", "o_orderpriority")
        .agg(F.min("o_orderstatus").alias("status"))
        .select(
            F.concat(F.lit("f"), "o_custkey").alias("file"),
            F.substring("o_orderpriority", 1, 1).cast("int").alias("ordinal"),
            F.col("o_orderpriority").alias("column"),
            F.when(kind == "F", "int").when(kind == "O", "varchar(20)").otherwise("date").alias("type"),
        )
    )


def sizes(t):
    mb = F.round(F.sum("o_totalprice") / 1048576, 4)
    return t.orders.groupBy(F.concat(F.lit("f"), "o_custkey").alias("file")).agg(mb.alias("size_mb"))


def sized_schemas(t):
    return schemas.file_schemas(catalog(t)).join(sizes(t), "file")


@query("q_fingerprint", CATALOG_SQL + "select file, fingerprint, column_count from sch")
def fingerprint(t):
    return schemas.file_schemas(catalog(t)).select("file", "fingerprint", "column_count")


GROUPS_SQL = CATALOG_SQL + """, g as (select fingerprint, count(*) as total_files, round(sum(mb), 2) as total_size_mb,
    min(file) as first_file from sch join sz using (file) group by 1 having count(*) > 1)
"""


@query("q_fingerprint_groups", GROUPS_SQL + "select * from g")
def fingerprint_groups(t):
    return schemas.fingerprint_groups(sized_schemas(t), F.col("size_mb")).drop("sample_schema")


@query(
    "q_group_totals",
    GROUPS_SQL
    + "select cast(sum(total_files) as bigint) as files, round(sum(total_size_mb), 2) as size_mb, count(*) as groups from g",
)
def group_totals(t):
    return schemas.group_totals(schemas.fingerprint_groups(sized_schemas(t), F.col("size_mb")))


def one_per_fingerprint(t):
    listed = schemas.file_schemas(catalog(t))
    heads = listed.groupBy("fingerprint").agg(
        F.count("*").alias("files"), F.min(F.struct("file", "names", "typed")).alias("s")
    )
    return heads.select("files", "s.*")


@query(
    "q_schema_similarity",
    CATALOG_SQL
    + f""", d as (select fingerprint, count(*) as files, min(file) as file, any_value(names) as names0, any_value(typed) as typed
        from sch group by 1), dd as (select files, file, names0 as names, typed from d)
      select a.file, b.file as base_file, {SCORE_SQL} as score from dd a, dd b where {SCORE_SQL} >= 0.8""",
)
def schema_similarity(t):
    heads = one_per_fingerprint(t)
    return schemas.similar_to(heads, heads)


GREEDY_SQL = CATALOG_SQL.replace("with cat", "with recursive cat") + f""",
  d as (select fingerprint, count(*) as files, min(file) as file from sch group by 1),
  h as (select d.fingerprint, d.files, d.file, s.names, s.typed from d join sch s on s.file = d.file),
  ex as (select file as leader, row_number() over (order by file) as n from h where files > 1),
  one as (select *, row_number() over (order by file) as i from h where files = 1),
  near as (select a.i, b.i as j, {SCORE_SQL} as score from one a join one b on b.i < a.i and {SCORE_SQL} >= 0.8),
  adj as (select one.i, list(near.j) filter (near.j is not null) as js from one left join near on near.i = one.i group by 1),
  walk(i, leaders) as (select cast(0 as bigint), cast([] as bigint[])
    union all select adj.i, case when len(list_intersect(walk.leaders, coalesce(adj.js, cast([] as bigint[])))) = 0
      then list_append(walk.leaders, adj.i) else walk.leaders end from walk join adj on adj.i = walk.i + 1),
  lead_list as (select unnest(leaders) as i from (select leaders from walk order by i desc limit 1)),
  member as (select one.i, case when one.i in (select i from lead_list) then one.i
      else (select min(near.j) from near where near.i = one.i and near.j in (select i from lead_list)) end as li from one),
  grp as (select li, count(*) as files, coalesce(min(near.score), cast(1 as double)) as least from member
      left join near on near.i = member.i and near.j = member.li group by li),
  numbered as (select grp.*, row_number() over (order by li) + (select count(*) from ex) as n from grp),
  names_ as (
    select h.fingerprint, 'parquet_group_' || printf('%03d', ex.n) || '_exact_match' as group_name, cast(1 as double) as similarity
      from h join ex on ex.leader = h.file
    union all select one.fingerprint, case when numbered.files > 1 then 'parquet_group_' || printf('%03d', numbered.n) || '_similar_schema'
      else 'individual_file_' || printf('%03d', numbered.n) end, numbered.least
      from one join member on member.i = one.i join numbered on numbered.li = member.li)
  select sch.file, group_name, cast(similarity as double) as similarity, mb as size_mb from sch join names_ using (fingerprint) join sz using (file)"""


@query("q_schema_groups", GREEDY_SQL)
def schema_groups(t):
    grouped = schemas.schema_groups(sized_schemas(t), F.col("size_mb"))
    return grouped.select("file", "group_name", "similarity", "size_mb")


@query(
    "q_schema_drift",
    """with e as (select o_custkey, lower(o_orderpriority) as col, min(o_orderstatus) as st from orders
         where o_orderdate < timestamp '1997-01-01' group by 1, 2),
       a as (select o_custkey, lower(o_orderpriority) as col, min(o_orderstatus) as st from orders
         where o_orderdate >= timestamp '1997-01-01' group by 1, 2),
       j as (select coalesce(e.o_custkey, a.o_custkey) as o_custkey, coalesce(e.col, a.col) as "column",
         case when e.st = 'O' then 'STRING' when e.st is not null then 'INTEGER' end as expected_type,
         case when a.st = 'O' then 'STRING' when a.st is not null then 'INTEGER' end as actual_type
         from e full outer join a on e.o_custkey = a.o_custkey and e.col = a.col)
       select *, case when expected_type is null then 'extra' when actual_type is null then 'missing' else 'matched' end as status,
         case when expected_type is not null and actual_type is not null then 'cast' when actual_type is null then 'null'
         when actual_type = 'STRING' then 'keep' else 'error' end as action from j""",
)
def schema_drift(t):
    def columns(orders):
        kind = F.when(F.min("o_orderstatus") == "O", "STRING").otherwise("INTEGER")
        return orders.groupBy("o_custkey", F.col("o_orderpriority").alias("name")).agg(kind.alias("type"))

    date = F.col("o_orderdate")
    before = columns(t.orders.filter(date < F.lit("1997-01-01").cast("timestamp_ntz")))
    since = columns(t.orders.filter(date >= F.lit("1997-01-01").cast("timestamp_ntz")))
    return schemas.schema_drift(before, since, ["o_custkey"])


NAME_FORMS = [
    "id", "name", "price", "created_at", "start_date", "active", "total_amount", "code", "birth_dt", "margin_x", "is", "num_",
    "ts_", "_time", "score",
]
NAME_FORMS_SQL = "[" + ", ".join(f"'{n}'" for n in NAME_FORMS) + "]"


@query(
    "q_infer_types",
    rf"""with n as (select p_partkey, replace(p_name, ' ', '_') || '_' || {NAME_FORMS_SQL}[(p_partkey % {len(NAME_FORMS)} + 1)] as tail,
         {NAME_FORMS_SQL}[(p_partkey % {len(NAME_FORMS)} + 1)] || '_' || split_part(p_name, ' ', 2) as head from part),
       u as (select p_partkey, 0 as side, case when p_partkey % 6 = 0 then regexp_replace(tail, '^.*_', '') else tail end as name
         from n union all select p_partkey, 1, head from n)
       select p_partkey, side, name, case when p_partkey % 10 = 9 then 'BYTES'
         when regexp_matches(name, '^(id|count|quantity|qty|number|num|size|age|year|month|day|week|hour|minute|second)$')
           or regexp_matches(name, '(_id|_count|_num|_qty|_size|_age|_year|_month|_day|_key|_code)$')
           or regexp_matches(name, '^(num_|count_|total_|max_|min_|id_)') then 'INTEGER'
         when regexp_matches(name, '^(rate|ratio|percentage|percent|score|weight|height|latitude|longitude|lat|lon|lng)$')
           or regexp_matches(name, '(_rate|_ratio|_percent|_percentage|_score|_weight|_height)$')
           or regexp_matches(name, '^rate_') or regexp_matches(name, 'amount|price|cost|revenue|profit|margin') then 'FLOAT64'
         when name in ('last_modified', 'last_updated') or regexp_matches(name, '_time$') or regexp_matches(name, '^ts_')
           or regexp_matches(name, 'timestamp|_at|datetime') then 'TIMESTAMP'
         when name = 'date' or regexp_matches(name, '_dt$|^dt_') or regexp_matches(name, '_date|date_') then 'DATE'
         when name in ('active', 'enabled', 'deleted', 'valid', 'verified', 'completed', 'success', 'failed')
           or regexp_matches(name, '^(is_|has_|can_|should_|will_|was_|are_)')
           or regexp_matches(name, '(_flag|_active|_enabled|_deleted)$') then 'BOOLEAN'
         else 'STRING' end as type from u""",
)
def infer_types(t):
    forms = F.array(*[F.lit(n) for n in NAME_FORMS])
    form = F.get(forms, (F.col("p_partkey") % len(NAME_FORMS)).cast("int"))
    tail = F.concat_ws("_", F.replace("p_name", F.lit(" "), F.lit("_")), form)
    head = F.concat_ws("_", form, F.substring_index("p_name", " ", -1))
    bare = F.when(F.col("p_partkey") % 6 == 0, F.substring_index(tail, "_", -1)).otherwise(tail)
    names = t.part.select("p_partkey", F.posexplode(F.array(bare, head)).alias("side", "name"))
    current = F.when(F.col("p_partkey") % 10 == 9, "BYTES").otherwise("STRING")
    return names.select("p_partkey", "side", "name", infer_type(F.col("name"), current).alias("type"))


# Type texts and their loose buckets.
LOOSE = {
    "varchar(10)": "string",
    "StringType()": "string",
    "bigint": "integer",
    "DecimalType(10,2)": "numeric",
    "float": "numeric",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp",
    "char(1)": "string",
    "array<string>": "string",
    "interval day to second": "other",
    "binary": "other",
    "smallint": "integer",
    "double": "numeric",
}
TYPE_TEXTS = list(LOOSE)
TYPES_SQL = "[" + ", ".join(f"'{x}'" for x in TYPE_TEXTS) + "]"
LOOSE_SQL = " ".join(f"when '{k}' then '{v}'" for k, v in LOOSE.items())


@query(
    "q_type_bucket",
    f"""with x as (select p_partkey, {TYPES_SQL}[(p_partkey % {len(TYPE_TEXTS)} + 1)] as type from part)
       select p_partkey, type, case type {LOOSE_SQL.replace("'other' when 'binary'", "'integer' when 'binary'")} end as loose,
         case type {LOOSE_SQL.replace("'other' when 'binary'", "'integer' when 'binary'").replace("'char(1)' then 'string'", "'char(1)' then 'other'")} end as strict
       from x""",
)
def buckets(t):
    kinds = F.array(*[F.lit(x) for x in TYPE_TEXTS])
    typed = t.part.select("p_partkey", F.get(kinds, (F.col("p_partkey") % len(TYPE_TEXTS)).cast("int")).alias("type"))
    kind = F.col("type")
    return typed.select("p_partkey", "type", type_bucket(kind).alias("loose"), type_bucket(kind, strict=True).alias("strict"))


RAW_NAME_SQL = """case p_partkey % 5 when 0 then '  ' || p_name || ' (%)' when 1 then upper(p_name) || '/ Total-' || p_brand
    when 2 then '***' when 3 then '__' || p_brand || '__' || p_type || '=' else p_name || ' {x}; ' || p_size || '%' end"""


@query(
    "q_names",
    f"""with r as (select p_partkey, p_size, {RAW_NAME_SQL} as raw from part),
       n as (select *, trim(regexp_replace(lower(raw), '[^a-z0-9]+', '_', 'g'), '_') as snake,
         trim(regexp_replace(regexp_replace(regexp_replace(replace(raw, '(%)', '_pct'), '[ ,;{{}}()\\n\\t=/%-]+', '_', 'g'),
           '[^A-Za-z0-9_]+', '', 'g'), '_+', '_', 'g'), '_') as clean from r)
       select p_partkey, snake, lower(case when clean = '' then 'unnamed_col' else clean end) as sanitized,
         regexp_replace(trim(lower(raw)), '[^a-zA-Z0-9]', '_', 'g') as schema_name,
         case when row_number() over (partition by p_size, snake order by p_partkey) = 1 then snake
           else snake || '__dup' || (row_number() over (partition by p_size, snake order by p_partkey) - 1) end as unique_name
       from n""",
)
def names(t):
    raw = t.part.select("p_partkey", "p_size", F.expr(RAW_NAME_SQL).alias("raw"))
    text = F.col("raw")
    made = raw.select(
        "p_partkey",
        "p_size",
        snake(text).alias("snake"),
        sanitize(text).alias("sanitized"),
        schema_name(text).alias("schema_name"),
    )
    return uniquify(made, ["p_size"], "snake", "p_partkey", "unique_name").drop("p_size")
