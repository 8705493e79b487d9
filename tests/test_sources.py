import json

import pytest
from pyspark.sql import functions as F
from workbooks import Date, write_half_broken, write_workbook

from gridloom.operators.dedup import dedup_stats, sample_above
from gridloom.operators.recon import size_buckets
from gridloom.plans.intake import dedup_job
from gridloom.sources import folder, workbook, writers
from gridloom.sources.files import indexed_files, list_files
from gridloom.sources.workbook import file_kind, grid_errors, grid_rows, grid_to_table, read_grid


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def mixed(tmp_path, spark):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,name\n1,x\n2,y\n2,y\n")
    (tmp_path / "in" / "b.CSV").write_text("id,score\n1,2.5\n1,2.5\n")
    (tmp_path / "in" / "c.json").write_text('{"id": 3, "name": "z"}\n')
    spark.createDataFrame([(4, "w")], "id long, name string").toPandas().to_parquet(tmp_path / "in" / "d.parquet")
    write_workbook(tmp_path / "in" / "e.xlsx", {"S": [["Id", "Name"], [5, "v"]]})
    return str(tmp_path / "in")


def test_folder_unites_by_name(spark, mixed):
    table = folder.read_folder(spark, mixed)
    assert sorted(table.columns) == ["id", "name", "score"]
    got = rows(table.select("id", "name", "score"))
    assert len(got) == 8
    assert ("1", None, 2.5) in got and ("5", "v", None) in got
    assert table.distinct().count() == 6


def test_dedup_job(spark, mixed, tmp_path):
    stats = dedup_job(spark, mixed, str(tmp_path / "out"))
    assert rows(stats) == [(8, 6, 2, 25.0)]
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_empty_folder_and_empty_table(spark, tmp_path):
    (tmp_path / "x.txt").write_text("nothing")
    with pytest.raises(ValueError):
        folder.read_folder(spark, str(tmp_path))
    assert rows(dedup_stats(spark.createDataFrame([], "a int"), ["a"])) == [(0, 0, 0, None)]


def test_awkward_file_names(spark, tmp_path):
    source = tmp_path / "my files"
    source.mkdir()
    (source / "a b%+(1)[x].csv").write_text("id,x\n1,2\n")
    (source / "c.csv").write_text("x,y\n3,4\n")
    (source / "é e.csv").write_text("")
    table = folder.read_folder(spark, str(source))
    assert rows(table.select("id", "x", "y")) == [(1, 2, None), (None, 3, 4)]
    listed = {r.path: r.length for r in list_files(spark, str(source)).collect()}
    assert {p.rsplit("/", 1)[1]: n for p, n in listed.items()} == {"a b%+(1)[x].csv": 9, "c.csv": 8, "é e.csv": 0}
    assert {r.path for r in folder.csv_headers(spark, str(source)).collect()} < set(listed)


def test_workbook_grid(spark, tmp_path):
    sheet = [["Name", None, "When", "OK"], [], ["x & y", 2.5, Date(45747), True], [None, 7, None, None]]
    write_workbook(tmp_path / "w.xlsx", {"First": sheet, "Second": [["a"]]})
    (tmp_path / "broken.xlsx").write_bytes(b"PK\x03\x04 not really")
    grid = read_grid(spark, str(tmp_path))
    assert [tuple(r) for r in grid_rows(grid).orderBy("row_idx").select("sheet", "row_idx", "cells").collect()] == [
        ("First", 0, ["Name", None, "When", "OK"]),
        ("First", 1, []),
        ("First", 2, ["x & y", "2.5", "2025-03-31 00:00:00", "True"]),
        ("First", 3, [None, "7"]),
    ]
    assert [r.file_path.endswith("broken.xlsx") for r in grid_errors(grid).collect()] == [True]
    assert grid_rows(read_grid(spark, str(tmp_path), all_sheets=True)).select("sheet").distinct().count() == 2
    small = read_grid(spark, str(tmp_path), size_limit=100)
    assert [r.reason.startswith("larger") for r in grid_errors(small).filter("file_path like '%w.xlsx'").collect()] == [True]


@pytest.mark.parametrize("held", [50_000, 1])
def test_workbooks_are_read_whole_or_not_at_all(spark, tmp_path, monkeypatch, held):
    monkeypatch.setattr(workbook, "ROWS_HELD", held)
    write_workbook(tmp_path / "good.xlsx", {"S": [["a"], ["b"], ["c"]]})
    write_half_broken(tmp_path / "half.xlsx")
    content = (tmp_path / "half.xlsx").read_bytes()
    [row] = workbook.unpack("half.xlsx", content, False)
    assert row[:5] == ("half.xlsx", None, None, None, None) and "Error" in row[5]
    assert len(list(workbook.unpack("good.xlsx", (tmp_path / "good.xlsx").read_bytes(), False))) == 3
    with pytest.raises(ValueError, match="half.xlsx"):
        folder.read_folder(spark, str(tmp_path))
    aside = str(tmp_path / "aside")
    assert folder.read_folder(spark, str(tmp_path), quarantine=aside).count() == 2
    assert [r.file_path.endswith("half.xlsx") for r in spark.read.parquet(aside).collect()] == [True]


def test_folders_below_a_folder(spark, tmp_path):
    (tmp_path / "in" / "sub" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "x.csv").write_text("id\n1\n")
    (tmp_path / "in" / "sub" / "y.csv").write_text("id\n2\n")
    (tmp_path / "in" / "sub" / "deep" / "z.csv").write_text("")
    write_workbook(tmp_path / "in" / "sub" / "w.xlsm", {"S": [["Id"], [3]]})
    listed = folder.file_catalog(spark, str(tmp_path / "in")).collect()
    assert sorted(r.name for r in listed) == ["w.xlsm", "x.csv", "y.csv", "z.csv"]
    assert sorted(r.id for r in folder.read_folder(spark, str(tmp_path / "in"), types="string").collect()) == ["1", "2", "3"]


def test_listing_level_by_level(spark, tmp_path):
    """Folders are listed in tasks: empty files, hidden names, odd names, globs; the same as from the index of a scan."""
    for name in ("a.txt", "x/b.CSV", "x/y/c d%+[1].csv", "x/y/z/e.csv", "x/_hidden.csv", "_tmp/f.csv", ".g", "x/k=1/_k=2/h.csv", "empty/.keep"):
        file = tmp_path / "in" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_bytes(b"" if name.endswith("e.csv") else b"0" * len(name))
    root = str(tmp_path / "in")

    def listed(df):
        return {(r.path.split("/in/")[1], r.length) for r in df.collect()}

    got = listed(list_files(spark, root))
    assert got == {("a.txt", 5), ("x/b.CSV", 7), ("x/y/c d%+[1].csv", 16), ("x/y/z/e.csv", 0), ("x/k=1/_k=2/h.csv", 16)}
    assert got == listed(indexed_files(spark, root))
    assert {p for p, _ in listed(list_files(spark, root, "*.[cC][sS][vV]"))} == {p for p, _ in got if not p.endswith("txt")}
    assert {p for p, _ in listed(list_files(spark, root, "{a,h}.*"))} == {"a.txt", "x/k=1/_k=2/h.csv"}
    assert listed(list_files(spark, root + "/a.txt")) == {("a.txt", 5)}
    assert listed(list_files(spark, root + "/x/y/*/")) == {("x/y/z/e.csv", 0), ("x/y/c d%+[1].csv", 16)}
    assert listed(list_files(spark, root + "/empty")) == set()
    with pytest.raises(FileNotFoundError):
        list_files(spark, root + "/nowhere")


def test_sample_is_repeatable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    first, second = (sorted(r.k for r in sample_above(x, 50, ["k"]).collect()) for x in (df, df.repartition(7)))
    assert first == second and len(first) == 50


def test_table_from_unlike_headers(spark, tmp_path):
    write_workbook(tmp_path / "a.xlsx", {"S": [["ID", "Total (%)", "ID"], ["1", 2, "3"]]})
    write_workbook(tmp_path / "b.xlsx", {"S": [["Total (%)", "Other"], [9, "o"]]})
    table = grid_to_table(grid_rows(read_grid(spark, str(tmp_path))))
    assert sorted(table.columns) == ["file_path", "id", "id__dup1", "other", "row_idx", "total"]
    assert rows(table.select("id", "id__dup1", "total", "other")) == [("1", "3", "2", None), (None, None, "9", "o")]


def test_file_kinds(spark, tmp_path):
    (tmp_path / "a.xls").write_bytes(bytes.fromhex("D0CF11E0A1B11AE1") + b"0" * 200)
    (tmp_path / "b.xlsx").write_bytes(b"PK\x03\x04" + b"0" * 200)
    (tmp_path / "c.xls").write_text("<html><TABLE></TABLE></html>")
    (tmp_path / "d.xls").write_bytes(b"")
    kinds = {r.path.rsplit("/", 1)[1]: (r.kind, r.tiny) for r in file_kind(spark, str(tmp_path)).collect()}
    assert kinds == {"a.xls": ("ole2", False), "b.xlsx": ("zip", False), "c.xls": ("html", True), "d.xls": ("empty", False)}


def test_lists_and_documents(spark, tmp_path):
    (tmp_path / "l.txt").write_text("# note\n\n a , b \n c,\n")
    entries = folder.split_list(folder.read_list(spark, str(tmp_path / "l.txt")), ["x", "y"])
    assert rows(entries.select("x", "y", "complete")) == [("a", "b", True), ("c", None, False)]
    (tmp_path / "p.txt").write_text("a|u|b\n")
    triple = folder.split_list(folder.read_list(spark, str(tmp_path / "p.txt")), ["p", "q", "r"], "|")
    assert rows(triple.select("p", "q", "r")) == [("a", "u", "b")]
    names = spark.range(1).select(folder.split_names(F.lit(" /a/ , ,b/c/")).alias("n"))
    assert names.first().n == ["a", "b/c"]
    (tmp_path / "s.json").write_text(json.dumps([{"name": "id", "type": "INTEGER"}, {"name": "t", "type": "STRING", "mode": "NULLABLE"}]))
    assert folder.read_schema_document(spark, str(tmp_path / "s.json")).count() == 2
    listing = [{"name": "a", "properties": {"contentLength": 5}}, {"name": "d", "folder": {"childCount": 1}}]
    (tmp_path / "j.json").write_text(json.dumps(listing))
    assert rows(folder.read_json_listing(spark, str(tmp_path / "j.json"))) == [("a", "file", 5), ("d", "folder", 0)]


def test_catalog_and_buckets(spark, tmp_path):
    (tmp_path / "a.CSV").write_bytes(b"0" * 2048)
    got = folder.file_catalog(spark, str(tmp_path)).first()
    assert (got.name, got.extension, got.size) == ("a.CSV", ".csv", 2048)
    mb = spark.createDataFrame([(round(x * 1048576),) for x in (9.99, 10.0, 50.0, 50.01)], "length long")
    sized = mb.select(F.round(F.col("length") / 1048576, 2).alias("s"))
    assert tuple(size_buckets(sized, F.col("s")).first())[2:] == (1, 2, 1)


def test_lineage_and_strict_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"say ""hi"""\n')
    table = folder.with_lineage(folder.read_csv(spark, str(tmp_path / "a.csv"), "string", strict=True))
    row = table.first()
    assert (row.id, row.t) == ("1", 'say "hi"') and row.source_file.endswith("a.csv") and row.processed_timestamp


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("a", 'q"x'), ("b", None)], "k string, v string")
    writers.write_csv(df, str(tmp_path / "c"), single=True, quote_all=True)
    parts = list((tmp_path / "c").glob("part-*.csv"))
    assert len(parts) == 1 and '"a","q""x"' in parts[0].read_text()
    for fmt in ("csv", "parquet", "json"):
        writers.write_format(df, str(tmp_path / fmt), fmt)
        writers.write_format(df, str(tmp_path / fmt), fmt)
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    writers.write_parquet(df, str(tmp_path / "parquet"), "WRITE_APPEND")
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 4
    with pytest.raises(Exception):
        writers.write_parquet(df, str(tmp_path / "parquet"), "EMPTY")
    assert writers.mode_of("whatever") == "overwrite"
    assert writers.write_bundle({"x": df, "none": df.limit(0)}, str(tmp_path / "b")) == ["x"]
    assert writers.create_typed_table(df, "typed_copy") == 2
    report = spark.createDataFrame([("s1", "b", 1), ("s1", "a", 2), ("s2", "c", 1)], "section string, value string, copies long")
    writers.write_sections(report, str(tmp_path / "r"))
    assert sorted(p.name for p in (tmp_path / "r").glob("section=*")) == ["section=s1", "section=s2"]
