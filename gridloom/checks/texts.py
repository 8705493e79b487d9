"""Casts, paths, entities and text normalising on texts derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridloom.checks.registry import query
from gridloom.functions import entities as ent
from gridloom.functions import names, paths
from gridloom.functions.casts import lenient_cast
from gridloom.operators import clean
from gridloom.operators.recon import megabytes
from gridloom.plans.listings import comparable_paths, load_tasks
from gridloom.sources.folder import JSON_LISTING, SCHEMA_DOCUMENT, list_entries, listing_entries, split_list
from gridloom.sources.workbook import OLE2_MAGIC, ZIP_MAGIC, kind_of

MESSY_SQL = """case p_partkey % 9 when 0 then p_brand when 1 then '$1,' || p_size || '.50' when 2 then 'NULL' when 3 then ''
    when 4 then p_size || 'e' || (p_size % 3) when 5 then '-' || p_size when 6 then p_size || '-3'
    when 7 then ' ' || p_retailprice || ' ' else null end"""


def part_texts(t, sql):
    return t.part.select("p_partkey", F.expr(sql).alias("v"))


@query(
    "q_cast_int",
    f"""with v as (select p_partkey, {MESSY_SQL} as v from part)
       select p_partkey, try_cast(regexp_replace(nullif(nullif(v, 'NULL'), ''), '[^0-9-]', '', 'g') as bigint) as n from v""",
)
def cast_int(t):
    return part_texts(t, MESSY_SQL).select("p_partkey", lenient_cast(F.col("v"), "INT64", mode="legacy").alias("n"))


@query(
    "q_cast_float",
    f"""with v as (select p_partkey, {MESSY_SQL} as v from part)
       select p_partkey, try_cast(regexp_replace(nullif(nullif(v, 'NULL'), ''), '[^0-9.-]', '', 'g') as double) as x from v""",
)
def cast_float(t):
    return part_texts(t, MESSY_SQL).select("p_partkey", lenient_cast(F.col("v"), "FLOAT64", mode="legacy").alias("x"))


@query(
    "q_cast_bool",
    """with v as (select l_orderkey, l_linenumber, case l_returnflag when 'A' then 'yes' when 'N' then l_linestatus else 'No' end
         as a, cast(l_linenumber % 3 as varchar) as b, lower(l_linestatus) as c from lineitem)
       select l_orderkey, l_linenumber, case when upper(a) in ('TRUE', 'T', 'YES', 'Y', '1') then true
         when upper(a) in ('FALSE', 'F', 'NO', 'N', '0') then false end as a,
         case b when '1' then true when '0' then false end as b, case c when 'f' then false end as c from v""",
)
def cast_bool(t):
    flag = F.col("l_returnflag")
    a = F.when(flag == "A", "yes").when(flag == "N", F.col("l_linestatus")).otherwise("No")
    b = (F.col("l_linenumber") % 3).cast("string")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        lenient_cast(a, "BOOL").alias("a"),
        lenient_cast(b, "BOOLEAN").alias("b"),
        lenient_cast(F.lower("l_linestatus"), "BOOL").alias("c"),
    )


@query(
    "q_cast_date",
    """with v as (select o_orderkey, case o_orderkey % 6 when 0 then strftime(o_orderdate, '%Y%m%d')
         when 1 then strftime(o_orderdate, '%Y-%m-%d') when 2 then strftime(o_orderdate, '%Y') when 3 then 'NULL'
         when 4 then strftime(o_orderdate, '%Y') || '1331' else strftime(o_orderdate, '%Y-%m-32') end as v from orders)
       select o_orderkey, strftime(case when v in ('NULL', '') then null
         when regexp_matches(v, '^[0-9]{8}$') then cast(try_strptime(v, '%Y%m%d') as date)
         else try_cast(v as date) end, '%Y-%m-%d') as d from v""",
)
def cast_date(t):
    date, key = F.col("o_orderdate"), F.col("o_orderkey") % 6
    year = F.date_format(date, "yyyy")
    text = (
        F.when(key == 0, F.date_format(date, "yyyyMMdd"))
        .when(key == 1, F.date_format(date, "yyyy-MM-dd"))
        .when(key == 2, year)
        .when(key == 3, "NULL")
        .when(key == 4, F.concat(year, F.lit("1331")))
        .otherwise(F.concat(F.date_format(date, "yyyy-MM"), F.lit("-32")))
    )
    return t.orders.select("o_orderkey", lenient_cast(text, "DATE").cast("string").alias("d"))


@query(
    "q_cast_ts",
    """with v as (select event_id, case event_id % 4 when 0 then strftime(ts, '%Y-%m-%d %H:%M:%S')
         when 1 then strftime(ts, '%Y-%m-%d') when 2 then 'no time' else '' end as v from events)
       select event_id, epoch_us(try_cast(v as timestamp)) as us from v""",
)
def cast_ts(t):
    key = F.col("event_id") % 4
    text = (
        F.when(key == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(key == 1, F.date_format("ts", "yyyy-MM-dd"))
        .when(key == 2, "no time")
        .otherwise("")
    )
    return t.events.select("event_id", F.unix_micros(lenient_cast(text, "TIMESTAMP")).alias("us"))


@query(
    "q_cast_string",
    f"""with v as (select p_partkey, {MESSY_SQL} as v from part) select p_partkey, nullif(v, 'NULL') as s from v""",
)
def cast_string(t):
    return part_texts(t, MESSY_SQL).select("p_partkey", lenient_cast(F.col("v"), "STRING").alias("s"))


@query(
    "q_path_parts",
    r"""with p as (select page_id, url, regexp_replace(url, '^https?://', '') as path from pages)
       select page_id, regexp_replace(path, '^.*/', '') as base_name, regexp_extract(path, '^(.*)/[^/]*$', 1) as directory,
         regexp_replace(path, '^[^/]*/', '') as inner_path,
         lower(regexp_extract(regexp_replace(path, '^.*/', ''), '(\.[^.]*)$', 1)) as suffix,
         case when starts_with(path, 'blog.') then substr(path, 6) else path end as stripped,
         case when strpos(url, '/en/') > 0 then substr(url, strpos(url, '/en/') + 4) else regexp_replace(url, '^.*/', '') end
           as from_url,
         case when starts_with(path, 'en/') then substr(path, 4) else path end as from_path from p""",
)
def path_parts(t):
    path = F.regexp_replace("url", "^https?://", "")
    return t.pages.select("page_id", "url", path.alias("path")).select(
        "page_id",
        paths.base_name(F.col("path")).alias("base_name"),
        paths.directory(F.col("path")).alias("directory"),
        paths.drop_first_part(F.col("path")).alias("inner_path"),
        paths.suffix(F.col("path")).alias("suffix"),
        paths.strip_prefix(F.col("path"), "blog.").alias("stripped"),
        paths.blob_name(F.col("url"), "en").alias("from_url"),
        paths.blob_name(F.col("path"), "en").alias("from_path"),
    )


@query(
    "q_path_filters",
    r"""select page_id, url from pages where not regexp_matches(url, '(\.net|\.html)$')
         and regexp_matches(url, 'example|blog') and not regexp_matches(url, 'spam|page=[0-9]')""",
)
def path_filters(t):
    url = F.col("url")
    keep = clean.extension_filter(url, exclude=[".net", " html"]) & clean.folder_filter(
        url, ["example ", "blog"], ["spam", "page=[0-9]"]
    )
    return t.pages.filter(keep).select("page_id", "url")


@query(
    "q_keyword_filter",
    r"""with f as (select p_partkey, p_name || case p_partkey % 3 when 0 then '.XLSX' when 1 then '.xls' else '.csv' end as name
         from part) select p_partkey, name from f where contains(lower(name), 'ring') and regexp_matches(lower(name), '(\.xls|\.xlsx)$')""",
)
def keyword_filter(t):
    key = F.col("p_partkey") % 3
    ext = F.when(key == 0, ".XLSX").when(key == 1, ".xls").otherwise(".csv")
    files = t.part.select("p_partkey", F.concat("p_name", ext).alias("name"))
    return files.filter(clean.keyword_filter(F.col("name"), "Ring", ["xls", "xlsx"]))


DATED_SQL = """case when page_id % 3 = 0 then regexp_replace(url, '^https?://', 'gs://')
    else regexp_replace(url, '^https?://', 'gs://') || '/Folder ' || (page_id % 7) || '/2025033' || (page_id % 2) || '/p.parquet' end"""


@query(
    "q_path_to_table",
    rf"""with p as (select page_id, regexp_replace(rtrim({DATED_SQL}, '/'), '/+', '/', 'g') as path from pages),
       i as (select page_id, path, regexp_replace(regexp_replace(path, '^[A-Za-z0-9]+:/', ''), '^[^/]*/', '') as inner_path from p),
       d as (select page_id, path, regexp_replace(regexp_replace(inner_path, '/[^/]+\.[^/]+$', ''), '/$', '') as folder from i),
       a as (select page_id, path, case when regexp_matches(folder, '(^|/)[^/]+/[0-9]{{8}}(/|$)')
           then regexp_extract(folder, '([^/]+)/[0-9]{{8}}(/|$)', 1) else regexp_replace(folder, '^.*/', '') end as a,
           string_split(folder, '/') as f from d)
       select page_id, case when trim(regexp_replace(regexp_replace(lower(a), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_') = ''
           then 'unknown_table' else trim(regexp_replace(regexp_replace(lower(a), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_') end
           as dated_table,
         trim(regexp_replace(regexp_replace(lower(case when len(f) >= 3 and regexp_matches(f[len(f)], '^[0-9]{{8}}$')
             then f[len(f) - 2] || '_' || f[len(f) - 1] when len(f) >= 2 then f[1] || '_' || f[2] else f[1] end),
           '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_') as leading_table
       from a""",
)
def path_to_table(t):
    raw = F.regexp_replace(F.rtrim(F.expr(DATED_SQL), F.lit("/")), "/+", "/")
    path = F.regexp_replace(raw, "^gs:/", "gs://")
    folder = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(F.col("path"), "^gs://[^/]*/", ""), r"/[^/]+\.[^/]+$", ""), "/$", ""
    )
    return t.pages.select("page_id", path.alias("path")).select(
        "page_id",
        paths.table_from_dated_path(F.col("path")).alias("dated_table"),
        paths.table_from_leading_parts(folder).alias("leading_table"),
    )


@query(
    "q_document_table",
    """with d as (select p_partkey, 'schemas/' || p_type || '/' || p_name || '-' || p_brand || '.json' as path from part)
       select p_partkey, trim(regexp_replace(regexp_replace(lower(regexp_replace(regexp_replace(path, '^.*/', ''), '.json$', '')),
         '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_') as table_name from d""",
)
def document_table(t):
    path = F.concat_ws("/", F.lit("schemas"), "p_type", F.concat("p_name", F.lit("-"), "p_brand", F.lit(".json")))
    return t.part.select("p_partkey", paths.table_from_document(path).alias("table_name"))


FILE_SQL = """'sales/' || lower(p_type) || '/' || case when p_size % 2 = 0 then '2025' || lpad(cast(p_size as varchar(2)), 2, '0') || '01/'
    else '' end || 'part ' || p_partkey || '.parquet'"""


@query(
    "q_table_tasks",
    rf"""with f as (select {FILE_SQL} as path from part),
       n as (select path, string_split(path, '/') as c from f),
       k as (select path, c[1] || '_' || c[2] as tbl from n),
       g as (select tbl as "table", min(path) as first_path, count(*) as files from k group by 1)
       select *, case when regexp_matches(first_path, '/[0-9]{{8}}/[^/]*$') then regexp_replace(first_path, '/[0-9]{{8}}/[^/]*$', '/*/*.parquet')
         else regexp_replace(first_path, '/[^/]*$', '/*.parquet') end as pattern from g""",
)
def table_tasks(t):
    return load_tasks(t.part, F.expr(FILE_SQL))


@query(
    "q_uri_parts",
    r"""with u as (select page_id, url, 'abfss://' || regexp_extract(url, '/([a-z]{2})/', 1) || '@acct' || page_id ||
         '.dfs.core.example/' || regexp_replace(url, '^.*/', '') as uri from pages)
       select page_id, nullif(regexp_extract(uri, '^[a-z]+://([^@/]+)@([^./]+)\.[^/]+/(.+)$', 1), '') as container,
         nullif(regexp_extract(uri, '^[a-z]+://([^@/]+)@([^./]+)\.[^/]+/(.+)$', 2), '') as account,
         nullif(regexp_extract(uri, '^[a-z]+://([^@/]+)@([^./]+)\.[^/]+/(.+)$', 3), '') as path,
         split_part(url, '/', 3) as host, regexp_replace(url, '^https?://[^/]+/', '') as site_path from u""",
)
def uri_parts(t):
    uri = F.concat(
        F.lit("abfss://"), F.regexp_extract("url", "/([a-z]{2})/", 1), F.lit("@acct"), "page_id",
        F.lit(".dfs.core.example/"), F.substring_index("url", "/", -1),
    )
    split = t.pages.select(
        "page_id", paths.storage_parts(uri).alias("s"), paths.site_parts(F.col("url")).alias("u")
    )
    return split.select("page_id", "s.*", F.col("u.host").alias("host"), F.col("u.path").alias("site_path"))


@query(
    "q_url_encode",
    """select page_id, replace(url_encode(url || ' é*~(+)'), '%2F', '/') as kept, url_encode(url || ' é*~(+)') as strict from pages""",
)
def url_encode(t):
    text = F.concat("url", F.lit(" é*~(+)"))
    return t.pages.select(
        "page_id", paths.percent_encode(text).alias("kept"), paths.percent_encode(text, keep_slash=False).alias("strict")
    )


@query(
    "q_share_token",
    """select page_id, 'u!' || rtrim(replace(replace(base64(encode(url || '?>~' || repeat(url, 3))), '/', '_'), '+', '-'), '=')
       as token from pages""",
)
def share_token(t):
    url = F.concat("url", F.lit("?>~"), F.repeat("url", 3))
    return t.pages.select("page_id", paths.share_token(url).alias("token"))


@query(
    "q_safe_name",
    r"""with n as (select conv_id, turn, case when turn % 2 = 0 then role || ' ' || conv_id else text end || '.Xlsx' as name
         from conversations)
       select conv_id, turn, case when regexp_matches(name, '[^\x00-\x7F]') or length(name) > 150 then md5(name) || '.Xlsx' else name end
         as safe from n""",
)
def safe_name(t):
    short = F.concat("role", F.lit(" "), "conv_id")
    name = F.concat(F.when(F.col("turn") % 2 == 0, short).otherwise(F.col("text")), F.lit(".Xlsx"))
    return t.conversations.select("conv_id", "turn", names.safe_file_name(name).alias("safe"))


@query(
    "q_copy_marker",
    r"""with f as (select p_partkey, p_name || ' (' || (p_partkey % 8) || ')' || case p_partkey % 4 when 0 then '.xlsx'
         when 1 then '.xls' when 2 then '.xlsm' else '.pdf' end as name from part)
       select p_partkey, name from f where regexp_matches(name, '\([1-5]\)') and not regexp_matches(name, 'pdf$')""",
)
def copy_marker(t):
    key = F.col("p_partkey")
    ext = F.when(key % 4 == 0, ".xlsx").when(key % 4 == 1, ".xls").when(key % 4 == 2, ".xlsm").otherwise(".pdf")
    files = t.part.select(key, F.concat("p_name", F.lit(" ("), key % 8, F.lit(")"), ext).alias("name"))
    return files.filter(clean.copy_marked(F.col("name")))


SIDED_SQL = """case c_custkey % 4 when 0 then 'Pre_' || c_mktsegment || '_Customers_' || c_custkey || '.xlsx'
    when 1 then 'Pre_' || c_mktsegment || '_Suppliers_' || c_custkey || '.xls'
    when 2 then 'SPGlobal_' || c_mktsegment || '_x.xlsx' else 'Other-' || c_custkey || '.xlsx' end"""


@query(
    "q_classify",
    """select c_custkey, case c_custkey % 4 when 0 then 'customer' when 1 then 'supplier' end as side,
         case when c_custkey % 4 = 3 then '' else c_mktsegment end as company from customer""",
)
def classify(t):
    files = t.customer.select("c_custkey", F.expr(SIDED_SQL).alias("f"))
    return files.select(
        "c_custkey", ent.file_side(F.col("f")).alias("side"), ent.sided_file_company(F.col("f")).alias("company")
    )


TITLE_SQL = """case c_custkey % 5 when 0 then c_name || ', NYSE:' || upper(substr(c_mktsegment, 1, 3)) || c_custkey || ' (old) (MI KEY: ' || c_custkey || ') | Overview'
    when 1 then c_name || ' NASDAQGS:' || upper(substr(c_mktsegment, 1, 4)) when 2 then c_name || ' (a) (ID ' || c_custkey || ') | More'
    when 3 then c_name || ' (KEY ' || c_custkey || ') | Text' else c_name end"""


@query(
    "q_entity_extract",
    """select c_custkey, case when c_custkey % 5 = 4 then null when c_custkey % 5 = 2 then c_name || ' (a)' else c_name end as name,
         case c_custkey % 5 when 0 then 'NYSE:' || upper(substr(c_mktsegment, 1, 3)) || c_custkey || ' (MI KEY: ' || c_custkey || ')'
         when 1 then 'NASDAQGS:' || upper(substr(c_mktsegment, 1, 4)) when 2 then '(ID ' || c_custkey || ')'
         when 3 then '(KEY ' || c_custkey || ')' end as key from customer""",
)
def entity_extract(t):
    titles = t.customer.select("c_custkey", F.expr(TITLE_SQL).alias("title"))
    return titles.select("c_custkey", ent.split_title(ent.title_cell(F.col("title"))).alias("e")).select("c_custkey", "e.*")


VENDOR_FILE_SQL = """case c_custkey % 3 when 0 then 'SPGlobal_' || initcap_segment || 'HoldingInc.NASDAQGSX_MIKEY' || c_custkey || '_SPCIQKEY9.xlsx'
    when 1 then 'SPGlobal_' || initcap_segment || 'Corporation_NYSEAB_TCUID' || c_custkey || '.xlsx'
    else 'Report_' || initcap_segment || '_NASDAQ_ABC_' || c_custkey || '.xlsx' end"""


@query(
    "q_filename_entity",
    """with s as (select c_custkey, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) as seg from customer)
       select c_custkey, case c_custkey % 3 when 0 then seg || ' Holding' when 1 then seg end as vendor_name,
         case c_custkey % 3 when 0 then 'NASDAQGS:X (MI KEY: ' || c_custkey || '; SPCIQ KEY: 9)'
           when 1 then 'NYSEA:B (TCUID: ' || c_custkey || ')' end as vendor_key,
         case c_custkey % 3 when 1 then seg || ' Corporation' when 2 then seg end as generic_name,
         case c_custkey % 3 when 1 then 'NYSE:YSEAB' when 2 then 'NASDAQ:ABC' end as generic_key from s""",
)
def filename_entity(t):
    seg = F.initcap(F.lower("c_mktsegment"))
    files = t.customer.select("c_custkey", seg.alias("initcap_segment")).select(
        "c_custkey", F.expr(VENDOR_FILE_SQL).alias("f")
    )
    vendor, generic = ent.vendor_file_entity(F.col("f")), ent.generic_file_entity(F.col("f"))
    both = files.select("c_custkey", vendor.alias("v"), generic.alias("g"))
    return both.select(
        "c_custkey",
        F.col("v.name").alias("vendor_name"),
        F.col("v.key").alias("vendor_key"),
        F.col("g.name").alias("generic_name"),
        F.col("g.key").alias("generic_key"),
    )


@query(
    "q_entity_fallback",
    r"""select conv_id, turn, length(trim(text)) between 6 and 49 and regexp_matches(trim(text), '^[A-ZÀ-ÖØ-Þ]')
         and contains(trim(text), ' ') and not regexp_matches(text, '[:#@%|=]')
         and not regexp_matches(lower(text), 'summary|overview|sustainability|climate|environment|social|governance|index|question|average')
         as likely, nullif(regexp_extract(trim(text) || ' (Key ' || conv_id || ')', '(\([^()]*Key[^()]*\))$', 1), '') as key
       from conversations""",
)
def entity_fallback(t):
    cell = F.concat(F.trim(F.regexp_replace("text", "[()]", "")), F.lit(" (Key "), "conv_id", F.lit(")"))
    return t.conversations.select(
        "conv_id", "turn", ent.looks_like_name(F.col("text")).alias("likely"), ent.keyed_cell(cell)["key"].alias("key")
    )


HEADER_SQL = """p_name || case p_partkey % 12 when 0 then ' ($M)' when 1 then ' (EUR M)' when 2 then ' (%)' when 3 then ' (MSEK)'
    when 4 then ' (count)' when 5 then ' (kEUR)' when 6 then ' (B12)' when 7 then ' (note)' when 8 then ' (SEKm) (x)' when 9 then ''
    when 10 then ' (Total M)' else ' (€ B)' end"""


@query(
    "q_currency",
    """with c as (select p_partkey, case p_partkey % 12 when 0 then '$M' when 1 then 'EUR M' when 3 then 'MSEK' when 5 then 'kEUR'
         when 6 then 'B12' when 8 then 'SEKm' when 11 then '€ B' end as found from part)
       select p_partkey, found, coalesce(found, '$M') as used from c""",
)
def currency(t):
    headers = t.part.select("p_partkey", ent.currency(F.expr(HEADER_SQL)).alias("found"))
    return headers.withColumn("used", F.coalesce("found", F.lit(ent.DEFAULT_CURRENCY)))


QUOTED_SQL = "replace(replace(text, 'e ', 'e’ “'), '. ', '.” – ‘—')"


@query(
    "q_normalise_text",
    f"""select doc_id, replace(replace(replace(replace(replace(replace({QUOTED_SQL}, '’', ''''), '‘', ''''), '“', '"'), '”', '"'),
         '–', '-'), '—', '-') as text from documents""",
)
def normalise_text(t):
    return t.documents.select("doc_id", names.normalise_typography(F.expr(QUOTED_SQL)).alias("text"))


@query(
    "q_file_kind",
    """select page_id, case page_id % 5 when 0 then 'zip' when 1 then 'ole2' when 2 then 'unknown' else 'html' end as kind
       from pages where html is not null""",
)
def file_kinds(t):
    """Contents made of whole pages: containers by their leading bytes, pages without their tags, pages as they are."""
    page, key = F.encode("html", "UTF-8"), F.col("page_id") % 5
    content = (
        F.when(key == 0, F.concat(F.unhex(F.lit(ZIP_MAGIC)), page))
        .when(key == 1, F.concat(F.unhex(F.lit(OLE2_MAGIC)), page))
        .when(key == 2, F.encode(F.replace("html", F.lit("<"), F.lit(" ")), "UTF-8"))
        .otherwise(page)
    )
    return t.pages.filter("html is not null").select("page_id", kind_of(content).alias("kind"))


@query(
    "q_list_lines",
    r"""with l as (select doc_id, trim(unnest(string_split(replace(text, '. ', chr(10) || '# '), chr(10))),
           ' ' || chr(9) || chr(13)) as line from documents),
       e as (select doc_id, line from l where line <> '' and not starts_with(line, '#')),
       p as (select *, nullif(trim(string_split(line, ',')[1], ' '), '') as first,
         nullif(trim(case when contains(line, ',') then line[strpos(line, ',') + 1:] end, ' '), '') as rest from e)
       select doc_id, count(*) as entries, count(*) filter (first is not null and rest is not null) as complete,
         sum(coalesce(length(first), 0))::bigint as first_chars, sum(coalesce(length(rest), 0))::bigint as rest_chars
       from p group by 1""",
)
def list_lines(t):
    """Every line of every text as a line of a list file, later sentences of a line as comments."""
    text = F.replace("text", F.lit(". "), F.lit("\n# "))
    lines = t.documents.select("doc_id", F.explode(F.split(text, "\n")).alias("value"))
    entries = split_list(list_entries(lines, keep=["doc_id"]), ["first", "rest"], keep=["doc_id"])
    chars = {c: F.sum(F.coalesce(F.length(c), F.lit(0))).alias(f"{c}_chars") for c in ("first", "rest")}
    return entries.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("entries"), F.count(F.when(F.col("complete"), 1)).alias("complete"), *chars.values()
    )


@query(
    "q_schema_document",
    """select p_partkey, lower(replace(p_name, ' ', '_')) as name,
         case p_partkey % 3 when 0 then 'INTEGER' when 1 then 'STRING' end as type, 'NULLABLE' as mode from part""",
)
def schema_document(t):
    """A schema document for each part, as text."""
    key = F.col("p_partkey") % 3
    field = F.struct(
        F.lower(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("name"),
        F.when(key == 0, "INTEGER").when(key == 1, "STRING").alias("type"),
        F.lit("NULLABLE").alias("mode"),
        F.lit(1).alias("other"),
    )
    texts = t.part.select("p_partkey", F.to_json(F.array(field)).alias("document"))
    read = F.from_json("document", f"array<struct<{SCHEMA_DOCUMENT}>>")
    return texts.select("p_partkey", F.explode(read).alias("f")).select("p_partkey", "f.*")


@query(
    "q_json_listing",
    """select o_orderkey, o_orderstatus as name, case when o_orderkey % 4 = 0 then 'folder' else 'file' end as kind,
         case when o_orderkey % 4 = 0 then 0 else o_orderkey * 1000 end as length from orders""",
)
def json_listing(t):
    """A listing of one object for each order, as text."""
    folder = F.col("o_orderkey") % 4 == 0
    size = F.struct((F.col("o_orderkey") * 1000).cast("long").alias("contentLength"))
    item = F.struct(
        F.col("o_orderstatus").alias("name"), F.when(folder, "true").alias("folder"), F.when(~folder, size).alias("properties")
    )
    texts = t.orders.select("o_orderkey", F.to_json(F.array(item)).alias("listing"))
    read = F.from_json("listing", f"array<struct<{JSON_LISTING}>>")
    return listing_entries(texts.select("o_orderkey", F.explode(read).alias("i")).select("o_orderkey", "i.*"), ["o_orderkey"])


@query(
    "q_comparable_paths",
    r"""with u as (select regexp_replace(url, '^https?://', '') || case page_id % 4 when 0 then '.pdf' when 1 then '.xlsx'
           when 2 then '.PDF' else '.csv' end as path from pages where regexp_matches(url, '^https?://[^/]*/'))
       select path from u where regexp_matches(path, '(\.pdf|\.xlsx|\.csv)$') and not regexp_matches(path, '(\.csv)$')
         and regexp_matches(regexp_replace(path, '/[^/]*$', ''), 'm\.|xampl')
         and not regexp_matches(regexp_replace(path, '/[^/]*$', ''), '/de')""",
)
def comparable(t):
    """Addresses as a listing with typographic signs; prefix, extension lists and folder lists at once."""
    key = F.col("page_id") % 4
    ending = F.when(key == 0, ".pdf").when(key == 1, ".xlsx").when(key == 2, ".PDF").otherwise(".csv")
    address = F.translate(F.regexp_replace("url", "^https?://", "root/"), "-", "–")
    listing = t.pages.filter(F.col("url").rlike("^https?://[^/]*/")).select(F.concat(address, ending).alias("line"))
    return comparable_paths(
        listing, F.col("line"), "root", include_ext=["pdf", " .xlsx", "csv"], exclude_ext=[".csv"],
        include_folders=["m\\.", "xampl"], exclude_folders=["/de"],
    )


@query(
    "q_megabytes",
    """select doc_id, n_chars / 1048576.0::double as exact, round(n_chars * 997 / 1048576.0::double, 2) as rounded from documents""",
)
def megabytes_of_texts(t):
    size = F.col("n_chars")
    return t.documents.select("doc_id", megabytes(size).alias("exact"), megabytes(size * 997, 2).alias("rounded"))
