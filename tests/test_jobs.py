import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions.casts import infer_type, lenient_cast, type_bucket
from gridloom.functions.names import sanitize, snake, tidy_header
from gridloom.functions.paths import table_from_dated_path
from gridloom.operators import ledger, recon, schemas
from gridloom.plans import intake, listings, pool
from gridloom.sources import manifest
from gridloom.sources.catalog import folder_catalog
from gridloom.streaming.intake import csv_stream, grid_stream, run_available, split_sink
from workbooks import write_half_broken, write_workbook


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_names_types_paths(spark):
    assert one(spark, sanitize(F.lit("Revenue Exposed/ Total Revenue (%)"))) == "revenue_exposed_total_revenue_pct"
    assert one(spark, sanitize(F.lit("***"))) == "unnamed_col"
    assert one(spark, snake(F.lit(" Ab--c! "))) == "ab_c"
    assert tidy_header(["X", "x ", "Y"]) == ["x", "x__dup1", "y"]
    wanted = {
        "user_id": "INTEGER", "unit_price": "FLOAT64", "created_at": "TIMESTAMP", "start_date": "DATE",
        "is_active": "BOOLEAN", "total_amount": "INTEGER", "title": "STRING",
    }
    for name, kind in wanted.items():
        assert one(spark, infer_type(F.lit(name), F.lit("STRING"))) == kind
    assert one(spark, infer_type(F.lit("user_id"), F.lit("BYTES"))) == "BYTES"
    assert one(spark, table_from_dated_path(F.lit("gs://b/x/My Table/20250331/p.parquet"))) == "my_table"
    assert one(spark, type_bucket(F.lit("array<string>"))) == "string"


CASTS = [
    ("INTEGER", {"NULL": None, "": None, "12.50": 1250, "1e5": 15, "5-3": None, "-7": -7}),
    ("FLOAT64", {"12.50": 12.5, "1e5": 15.0, "": None}),
    ("BOOL", {"yes": True, "N": False, "maybe": None}),
    ("STRING", {"NULL": None, "": ""}),
]


@pytest.mark.parametrize("kind,cases", CASTS)
def test_casts(spark, kind, cases):
    for text, wanted in cases.items():
        assert one(spark, lenient_cast(F.lit(text), kind, mode="legacy")) == wanted


def test_dates_and_safe_mode(spark):
    dates = {"20250331": "2025-03-31", "2025-03-31": "2025-03-31", "2025": None, "20251331": None, "NULL": None}
    for text, wanted in dates.items():
        assert one(spark, lenient_cast(F.lit(text), "DATE").cast("string")) == wanted
    assert one(spark, lenient_cast(F.lit("12.50"), "INTEGER")) is None
    assert one(spark, lenient_cast(F.lit("12.50"), "FLOAT64")) == 12.5
    assert one(spark, lenient_cast(F.lit(5.0), "INTEGER", T.DoubleType())) == 5


DOCUMENT = [{"name": "id", "type": "INTEGER"}, {"name": "Amt", "type": "FLOAT64"}, {"name": "gone", "type": "DATE"}]


def test_typed_load(spark, tmp_path):
    (tmp_path / "doc.json").write_text(json.dumps(DOCUMENT))
    staging = spark.createDataFrame([("1", "2.5", "n"), ("NULL", "x", "m")], "id string, amt string, note string")
    staging.write.parquet(str(tmp_path / "st"))
    assert intake.typed_load_job(spark, str(tmp_path / "doc.json"), [str(tmp_path / "st")], "loaded") == 2
    table = spark.table("loaded")
    assert [f.dataType.simpleString() for f in table.schema] == ["bigint", "double", "date", "string"]
    assert sorted(map(tuple, table.collect()), key=str) == [(1, 2.5, None, "n"), (None, None, None, "m")]
    with pytest.raises(ValueError):
        intake.typed_columns(staging.withColumn("bad", F.lit(1)), [("id", "INTEGER")])
    document = spark.createDataFrame([("id", "INTEGER"), ("gone", "DATE")], "name string, type string")
    drift = {r.column: (r.status, r.action) for r in intake.drift_job(spark, document, staging.withColumn("bad", F.lit(1))).collect()}
    assert drift == {
        "id": ("matched", "cast"), "gone": ("missing", "null"), "amt": ("extra", "keep"), "note": ("extra", "keep"), "bad": ("extra", "error")
    }


def test_extract_schema(spark, tmp_path):
    spark.createDataFrame([("1", 2.0, "x")], "user_id string, price double, title string").write.parquet(str(tmp_path / "p"))
    target = str(tmp_path / "schema")
    assert intake.extract_schema_job(spark, [str(tmp_path / "p")], target)
    fields = json.loads(spark.read.text(target).first().value)
    assert [(f["name"], f["type"], f["mode"]) for f in fields] == [
        ("user_id", "INTEGER", "NULLABLE"), ("price", "FLOAT64", "NULLABLE"), ("title", "STRING", "NULLABLE")
    ]
    assert not intake.extract_schema_job(spark, [str(tmp_path / "p")], target)


def test_list_jobs(spark, tmp_path):
    data = tmp_path / "My Table" / "20250331"
    spark.createDataFrame([("1", "a")], "id string, note string").write.parquet(str(data))
    (tmp_path / "p.txt").write_text(f"# paths\n{data}\n")
    assert [tuple(r)[:3] for r in intake.extract_list_job(spark, str(tmp_path / "p.txt"), str(tmp_path / "out")).collect()] == [
        ("my_table", "ok", 1)
    ]
    (tmp_path / "some-Doc.json").write_text(json.dumps([{"name": "id", "type": "INTEGER"}]))
    (tmp_path / "l.txt").write_text(f"{tmp_path}/some-Doc.json, {data}\n{tmp_path}/gone.json, {data}\nonly-one\n")
    done = intake.load_list_job(spark, str(tmp_path / "l.txt")).collect()
    assert sorted((r.table, r.status, r.rows) for r in done) == [("gone", "fail", 0), ("only_one", "fail", 0), ("some_doc", "ok", 1)]
    assert spark.table("some_doc").first().asDict() == {"id": 1, "note": "a"}


def test_quarantine_budget(spark):
    rows = spark.createDataFrame([(1,), (-1,), (-2,)], "n int")
    flagged = ledger.quarantine(rows, {"negative": F.col("n") < 0})
    ledger.check_budget(flagged, 2)
    with pytest.raises(ValueError):
        ledger.check_budget(flagged, 1)


def test_recon_job(spark, tmp_path):
    (tmp_path / "l.txt").write_text("a.xlsx\na.xlsx\nb/it’s.xlsx\nc.tmp\n")
    (tmp_path / "r.txt").write_text("prefix/a.xlsx\nprefix/b/it's.xlsx\nprefix/d.xlsx\n")
    totals = listings.recon_job(
        spark, str(tmp_path / "l.txt"), str(tmp_path / "r.txt"), str(tmp_path / "o"), "prefix", include_ext=[".xlsx"]
    ).first()
    assert tuple(totals) == (3, 3, 2, 1, 1)
    report = spark.read.parquet(str(tmp_path / "o" / "report"))
    got = {(r.section, r.value) for r in report.filter("section like 'missing%' or section = 'common'").collect()}
    assert got == {("common", "a.xlsx"), ("common", "b/it's.xlsx"), ("missing_in_right", "a.xlsx"), ("missing_in_left", "d.xlsx")}


def test_expand_copies_in_chunks(spark):
    df = spark.createDataFrame([("a", 25), ("b", 1), ("c", 0)], "k string, n long")
    got = {r.k: r["count"] for r in recon.expand_copies(df, "n", chunk=4).groupBy("k").count().collect()}
    assert got == {"a": 25, "b": 1}


CATALOG = {
    "f1": "a:int b:string", "f2": "b:string a:bigint",
    "f3": "a:int b:string c:int d:int e:int", "f4": "a:int b:string c:int d:int e:int f:int",
    "f5": "x:int y:int", "f6": "x:int y:int z:int",
}


def test_grouping_job(spark, tmp_path):
    rows = [(f, i, *c.split(":")) for f, cols in CATALOG.items() for i, c in enumerate(cols.split())]
    catalog = spark.createDataFrame(rows, "file string, ordinal int, column string, type string")
    sizes = spark.createDataFrame([(f, 1.5) for f in CATALOG], "file string, size_mb double")
    totals = listings.grouping_job(catalog, sizes, str(tmp_path / "g")).first()
    assert tuple(totals) == (6, 9.0, 4)
    got = {r.file: (r.group_name, round(r.similarity, 4), r.recommended_name) for r in spark.read.parquet(str(tmp_path / "g" / "groups")).collect()}
    assert got["f1"] == got["f2"] == ("parquet_group_001_exact_match", 1.0, "parquet_group_001_exact_match.parquet")
    assert got["f3"] == got["f4"] == ("parquet_group_002_similar_schema", 0.8833, "parquet_group_002_similar_schema.parquet")
    assert got["f5"] == ("individual_file_003", 1.0, "f5.parquet") and got["f6"][0] == "individual_file_004"


def test_folder_catalog_and_grouping(spark, tmp_path):
    source = tmp_path / "my files"
    source.mkdir()
    (source / "a.csv").write_text('id,"na,me",when,x\n1,"p,q",2025-01-02,2.5\n22,r,2025-01-03,\n')
    (source / "b.csv").write_text("x,when,id,\"na,me\"\n1,2025-01-02 03:04:05,5,z\n")
    (source / "c.json").write_text('{"id": 1, "tag": "t"}\n{"id": 2, "more": {"a": 1}}\n')
    spark.createDataFrame([(1, 2.0)], "k long, v double").toPandas().to_parquet(source / "d.parquet")
    write_workbook(source / "e.xlsx", {"S": [["k", None, "v"], ["1", None, "2"]]})

    def columns(infer):
        got = {}
        for r in folder_catalog(spark, str(source), infer).orderBy("file", "ordinal").collect():
            got.setdefault(r.file.rsplit("/", 1)[1], []).append((r.column, r.type))
        return got

    loose = columns(False)
    assert loose["a.csv"] == [(c, "string") for c in ("id", "na,me", "when", "x")]
    assert [c for c, _ in loose["c.json"]] == ["id", "more", "tag"] and dict(loose["c.json"])["tag"] == "string"
    assert loose["d.parquet"] == [("k", "int64"), ("v", "double")]
    assert loose["e.xlsx"] == [("k", "string"), ("v", "string")]
    strict = columns(True)
    assert strict["a.csv"] == [("id", "int"), ("na,me", "string"), ("when", "date"), ("x", "double")]
    assert dict(strict["b.csv"])["when"] == "timestamp"
    totals = listings.group_folder_job(spark, str(source), str(tmp_path / "g")).first()
    assert (totals.files, totals.groups) == (5, 4)


def sequential(rows):
    """The rule one schema after the other: file -> leader."""
    leaders, wanted = [], {}
    for f, _, n, ty in sorted(rows, key=lambda r: r[1]):
        for g, m, tz in leaders:
            common = set(n) & set(m)
            score = 0.7 * len(common) / (len(set(n) | set(m)) or 1) + (0.3 * len(set(ty) & set(tz)) / len(common) if common else 0)
            if round(score, 9) >= 0.8:
                wanted[f] = g
                break
        else:
            leaders.append((f, n, ty))
            wanted[f] = f
    return wanted


SINGLES = "file string, ord long, names array<string>, typed array<string>"


@pytest.mark.parametrize("seed, letters, sizes, held", [(5, "abcdefgh", (2, 7), 4096), (6, "abcdefghijkl", (5, 11), 3), (7, "abc", (0, 3), 1)])
def test_leaders_equal_the_sequential_rule(spark, monkeypatch, seed, letters, sizes, held):
    import random

    monkeypatch.setattr(schemas, "HELD_AT_ONCE", held)
    rng = random.Random(seed)
    rows = [(f"s{i:03d}", 2 * i, sorted(rng.sample(letters, rng.randint(*sizes)))) for i in rng.sample(range(60), 60)]
    rows = [(f, o, n, [f"{x}:{rng.choice('is')}" for x in n]) for f, o, n in rows]
    got = schemas.assign_leaders(spark.createDataFrame(rows, SINGLES)).collect()
    assert {r.file: r.leader for r in got} == sequential(rows) and len(got) == len(rows)


def test_leaders_along_a_chain(spark):
    """Each schema is similar to its neighbours only, so that every decision waits for the one before."""
    rows = [(f"s{i:02d}", i, [f"n{j:03d}" for j in range(4 * i, 4 * i + 30)]) for i in range(20)]
    rows = [(f, o, n, [f"{x}:s" for x in n]) for f, o, n in rows]
    got = {r.file: r.leader for r in schemas.assign_leaders(spark.createDataFrame(rows, SINGLES)).collect()}
    assert got == sequential(rows) and len(set(got.values())) == 10


def test_a_name_that_every_schema_holds_is_in_no_prefix(spark):
    rows = [(f"s{i}", ["id", *(f"c{i}_{j}" for j in range(6))]) for i in range(40)]
    df = spark.createDataFrame(rows, "file string, names array<string>")
    prefix = schemas._prefixes(df, schemas._name_counts(df), 0.8, ["file"])
    assert prefix.count() == 40 * 3 and prefix.filter("name = 'id'").isEmpty()
    few = spark.createDataFrame([("a", ["id"]), ("b", ["id"])], "file string, names array<string>")
    assert schemas._prefixes(few, schemas._name_counts(few), 0.8, ["file"]).filter("name = 'id' and held = 2").count() == 2


def test_size_report_and_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a, b.bin").write_bytes(b"0" * 1048576)
    got = listings.size_report_job(spark, str(tmp_path / "in"), str(tmp_path / "out"), low=0.5, high=2)
    assert tuple(got.first()) == (1, 1.0, 0, 1, 0)
    files = spark.createDataFrame([("s/t/20250101/a.parquet",), ("s/t/20250102/b.parquet",), ("s/u/c.parquet",)], "p string")
    tasks = {r.table: (r.files, r.pattern) for r in listings.load_tasks(files, F.col("p")).collect()}
    assert tasks == {"s_t": (2, "s/t/*/*.parquet"), "s_u": (1, "s/u/*.parquet")}


def test_batch_increment(spark, tmp_path):
    source, ledger = tmp_path / "in", str(tmp_path / "ledger")
    source.mkdir()
    seen = []

    def process(files):
        seen.append(sorted(r.name for r in files.collect()))
        bad = F.col("name").contains("bad")
        return files.select("path", F.when(bad, "fail").otherwise("ok").alias("status"), F.when(bad, "unreadable").alias("reason"))

    (source / "one.csv").write_text("x")
    (source / "bad.csv").write_text("x")
    intake.batch_increment(spark, str(source), ledger, process, "", [".csv"])
    (source / "two.csv").write_text("x")
    intake.batch_increment(spark, str(source), ledger, process, "", [".csv"])
    intake.batch_increment(spark, str(source), ledger, process, "", [".csv"], by="name")
    assert seen == [["bad.csv", "one.csv"], ["bad.csv", "two.csv"], ["bad.csv"]]


def test_csv_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    good, bad, mark = (str(tmp_path / n) for n in ("good", "bad", "mark"))

    def run():
        run_available(csv_stream(spark, str(source), "id int, v string"), mark, split_sink(good, bad))
        return spark.read.parquet(good).count()

    (source / "f1.csv").write_text("id,v\n1,a\nnope,b\n")
    assert run() == 1
    (source / "f2.csv").write_text("id,v\n2,c\n")
    assert run() == 2
    assert run() == 2
    assert [r.reason for r in spark.read.parquet(bad).collect()] == ["malformed record"]


def test_grid_stream(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_workbook(source / "a.xlsx", {"S": [["x", "y"], ["1", 2]]})

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{tmp_path}/grid/batch={batch_id}")

    run_available(grid_stream(spark, str(source)), str(tmp_path / "mark"), sink)
    assert spark.read.parquet(f"{tmp_path}/grid").count() == 2


def test_grid_stream_quarantines_what_it_cannot_read(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    write_workbook(source / "good.xlsx", {"S": [["x", "y"], ["1", 2]]})
    write_half_broken(source / "half.xlsx")
    write_workbook(source / "large.xlsx", {"S": [[f"text {i}"] for i in range(900)]})

    def sink(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{tmp_path}/grid/batch={batch_id}")

    limit = max((source / n).stat().st_size for n in ("good.xlsx", "half.xlsx"))
    run_available(grid_stream(spark, str(source), size_limit=limit), str(tmp_path / "mark"), sink)
    got = spark.read.parquet(f"{tmp_path}/grid").groupBy("file_path").agg(
        F.count("row_idx").alias("cells"), F.count("error").alias("errors"))
    assert {r.file_path.rsplit("/", 1)[1]: (r.cells, r.errors) for r in got.collect()} == {
        "good.xlsx": (2, 0), "half.xlsx": (0, 1), "large.xlsx": (0, 1)}


def test_table_increment_is_all_or_nothing(spark, tmp_path, monkeypatch):
    """A run that breaks off before, between or after its writes is repeated; every row is there once."""
    source, target = tmp_path / "in", str(tmp_path / "table")
    source.mkdir()
    (source / "one.csv").write_text("id\n1\n2\n")
    (source / "bad.csv").write_text("")

    def process(files):
        bad = F.col("name").contains("bad")
        outcomes = files.select("path", F.when(bad, "fail").otherwise("ok").alias("status"), F.when(bad, "unreadable").alias("reason"))
        paths = [r.path for r in files.filter(~bad).collect()]
        data = spark.read.option("header", True).schema("id int").csv(paths) if paths else spark.createDataFrame([], "id int")
        return data, outcomes

    def ids():
        return sorted(r.id for r in manifest.read_table(spark, target, "id int").collect())

    assert ids() == [] and manifest.read_ledger(spark, target).count() == 0
    publish = manifest.publish

    def broken(*_):
        raise RuntimeError("lost before the commit")

    monkeypatch.setattr(manifest, "publish", broken)
    with pytest.raises(RuntimeError):
        intake.table_increment(spark, str(source), target, process, "", [".csv"])
    assert ids() == [] and manifest.read_ledger(spark, target).count() == 0
    monkeypatch.setattr(manifest, "publish", publish)
    done = intake.table_increment(spark, str(source), target, process, "", [".csv"])
    assert sorted(r.status for r in done.collect()) == ["fail", "ok"] and ids() == [1, 2]
    (source / "two.csv").write_text("id\n3\n")

    def half(data, outcomes):
        data.write.parquet(f"{target}/data/run=half")
        raise RuntimeError("lost between data and ledger")

    monkeypatch.setattr(manifest, "commit_run", lambda spark, target, data, outcomes: half(data, outcomes))
    with pytest.raises(RuntimeError):
        intake.table_increment(spark, str(source), target, process, "", [".csv"])
    monkeypatch.undo()
    assert ids() == [1, 2]
    intake.table_increment(spark, str(source), target, process, "", [".csv"])
    intake.table_increment(spark, str(source), target, process, "", [".csv"])
    assert ids() == [1, 2, 3] and manifest.runs(spark, target).count() == 3


def test_pool_runs_several_lines_and_tries_again(spark, monkeypatch):
    import threading
    import time

    monkeypatch.setattr(pool, "HELD", 4)
    lock, now, most, tries = threading.Lock(), [0], [0], {}

    def run(line):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
            tries[line["table"]] = tries.get(line["table"], 0) + 1
        time.sleep(0.2)
        with lock:
            now[0] -= 1
        if line["table"] == "t3":
            raise RuntimeError("never")
        if line["table"] == "t4":
            raise ValueError("wrong for good")
        if line["table"] == "t5" and tries["t5"] < 3:
            raise RuntimeError("not yet")
        return spark.range(int(line["table"][1:])).count()

    lines = ({"table": f"t{i}"} for i in range(12))
    got = {r.table: r for r in pool.run_lines(spark, lines, run, pool.Pool(4, 3, 0.01)).collect()}
    assert len(got) == 12 and most[0] == 4
    assert {t for t, r in got.items() if r.status == "fail"} == {"t3", "t4"}
    assert (got["t3"].attempts, got["t4"].attempts, got["t5"].attempts, got["t7"].rows) == (4, 1, 3, 7)
    assert got["t3"].reason == "RuntimeError: never"
    assert pool.run_lines(spark, [], run).count() == 0


def test_first_listed_path(spark):
    files = spark.createDataFrame([("s/t/20250102/b.parquet", 0), ("s/t/a/c.parquet", 1), ("s/t/20250101/a.parquet", 2)], "p string, n int")
    table = F.lit("x")
    assert listings.load_tasks(files, F.col("p"), table).first().first_path == "s/t/20250101/a.parquet"
    assert listings.load_tasks(files, F.col("p"), table, F.col("n")).first().first_path == "s/t/20250102/b.parquet"
