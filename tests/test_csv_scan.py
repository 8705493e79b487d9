"""Many headers in one scan, malformed lines, folders below folders."""

import pytest
from pyspark.sql import functions as F

from gridloom.plans.listings import group_folder_job
from gridloom.sources import catalog, folder
from gridloom.sources.csv_scan import QUOTES, SHORT, WIDE, data_lines, fields_of, scan_csv
from gridloom.streaming.intake import csv_stream, grid_stream, run_available, split_sink
from workbooks import write_workbook


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("line, wanted", [
    ("a,b", ["a", "b"]), (",", [None, None]), ("", [None]), ("a,", ["a", None]), (",a", [None, "a"]), ('""', [""]),
    ('"a,b",c', ["a,b", "c"]), ('"say ""hi""",2', ['say "hi"', "2"]), ('"say \\"hi\\"",2', ['say "hi"', "2"]),
    ('"a,b', None), ('"a"b,c', None), ('5" pipe,b', ['5" pipe', "b"]), ('5" pipe,6" pipe', ['5" pipe', '6" pipe']),
    ('x,"a","",,"b,"', ["x", "a", "", None, "b,"]), ('a"b"c,d', ['a"b"c', "d"]), ("c:\\x,y", ["c:\\x", "y"]),
    ('"a\u0001,b",c', ["a\u0001,b", "c"]), (" a , b ", [" a ", " b "]), ('"",', ["", None]), ('é,"日,本"', ["é", "日,本"]),
])
def test_fields(spark, line, wanted):
    assert fields_of(spark.createDataFrame([(line,)], "v string"), "v", "f").first().f == wanted


def test_a_line_of_many_quotes(spark):
    line = '"' + 'x ""y"", ' * 50_000 + '",z'
    got = fields_of(spark.createDataFrame([(line,)], "v string"), "v", "f").first().f
    assert got == ['x "y", ' * 50_000, "z"]


@pytest.fixture
def drop(tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.csv").write_text('id,name\n1,x\nid,name\n2,"y, z"\n3,"open\n4,a,b\n\n5\n')
    (tmp_path / "in" / "sub" / "b.csv").write_text("NAME,score,id\nq,2.5,7\n")
    (tmp_path / "in" / "only_header.csv").write_text("extra\n")
    (tmp_path / "in" / "empty.csv").write_text("")
    return str(tmp_path / "in")


def test_good_rows_and_quarantine(spark, drop):
    scan = scan_csv(spark, drop, source="file")
    assert scan.good.columns == ["file", "id", "name", "extra", "score"]
    good = scan.good.select("id", "name", "score", "extra")
    # A line that looks like the header is a row; it makes the column a text.
    assert rows(good) == sorted([("1", "x", None, None), ("id", "name", None, None), ("2", "y, z", None, None), ("5", None, None, None),
                                 ("7", "q", 2.5, None)], key=str)
    assert rows(scan.bad.select("record", "reason")) == [('3,"open', QUOTES), ("4,a,b", WIDE)]
    assert (scan.rows, scan.malformed) == (5, 2)
    assert [r.file_path.endswith("a.csv") for r in scan.bad.collect()] == [True, True]
    strict = scan_csv(spark, drop, short="quarantine")
    assert ("5", SHORT) in rows(strict.bad.select("record", "reason")) and strict.malformed == 3


def test_skip_budget_and_error(spark, drop, tmp_path):
    with pytest.raises(ValueError, match="malformed"):
        folder.read_folder(spark, drop)
    assert folder.read_folder(spark, drop, bad_lines="skip").count() == 5
    with pytest.raises(ValueError, match="budget of 1"):
        folder.read_folder(spark, drop, bad_lines="skip", budget=1)
    aside = str(tmp_path / "aside")
    write_workbook(tmp_path / "in" / "w.xlsx", {"S": [["Id"], [9]]})
    (tmp_path / "in" / "bad.xlsx").write_bytes(b"PK\x03\x04 no")
    assert folder.read_folder(spark, drop, quarantine=aside, budget=2).count() == 6
    assert sorted(r.record or "" for r in spark.read.parquet(aside).collect()) == ["", '3,"open', "4,a,b"]


def test_a_thousand_headers(spark, tmp_path):
    """One scan: the plan has as many nodes for a thousand headers as for one."""
    for i in range(1_000):
        names = [f"c{j}" for j in range(i % 40, i % 40 + 3)] + [f"k{i // 40}"]
        (tmp_path / f"f{i:04}.csv").write_text(",".join(names[::-1 if i % 2 else 1]) + "\n" + ",".join([str(i)] * 4) + "\n")
    scan = scan_csv(spark, str(tmp_path))
    assert len(scan.good.columns) == 42 + 25 and (scan.rows, scan.malformed) == (1_000, 0)
    assert dict(scan.good.dtypes)["c3"] == "int"
    assert scan.good.agg(F.sum("k3"), F.count("k3"), F.count("c0")).first()[:] == (sum(range(120, 160)), 40, 25)
    # Scans of the stored rows only, without a union.
    plan = scan.good._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Relation") == 1


def test_repeated_and_empty_names(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\ufeffx,,X,y \n1,2,3,4\n".encode())
    assert rows(scan_csv(spark, str(tmp_path)).good) == [(1, 2, 3, 4)]
    assert scan_csv(spark, str(tmp_path)).good.columns == ["x0", "_c1", "X2", "y"]


def test_more_files_than_are_sent(spark, drop, monkeypatch):
    from gridloom.sources import csv_scan

    wanted = rows(scan_csv(spark, drop).good)
    monkeypatch.setattr(csv_scan, "FILES_SENT", 0)
    assert rows(scan_csv(spark, drop).good) == wanted


def test_types(spark, tmp_path):
    (tmp_path / "a.csv").write_text("i,l,d,b,t,s,day,none\n1,5000000000,1,true,2024-01-02 03:04:05,x,2024-01-02,\n2,1,2.5,false,2024-01-02,7,2024-02-02,\n")
    (tmp_path / "b.csv").write_text("i,s\n,\n-3,1.5\n")
    assert dict(scan_csv(spark, str(tmp_path)).good.dtypes) == {
        "i": "int", "l": "bigint", "d": "double", "b": "boolean", "t": "timestamp", "s": "string", "day": "date", "none": "string"}
    assert set(dict(scan_csv(spark, str(tmp_path), "string").good.dtypes).values()) == {"string"}


def test_lines_by_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n"q\n\u0001x\u0001y,\n  z\\n"\na,b\n')
    assert [r.value for r in data_lines(spark, str(tmp_path)).collect()] == ['"q', "\u0001x\u0001y,", '  z\\n"', "a,b"]


def test_catalog_of_folders_below(spark, tmp_path):
    source = tmp_path / "in"
    (source / "sub").mkdir(parents=True)
    (source / "p.json").write_text('{"id": 1}\n')
    (source / "sub" / "q.json").write_text('{"id": 2}\n')
    (source / "sub" / "y.csv").write_text("v\n3\n4.5\nv2\n".replace("v2\n", ""))
    (source / "x.csv").write_text("w\nw\n1\n")
    got = {(r.file.rsplit("/", 1)[1], r.column, r.type) for r in catalog.folder_catalog(spark, str(source), infer=True).collect()}
    assert got == {("p.json", "id", "bigint"), ("q.json", "id", "bigint"), ("y.csv", "v", "double"), ("x.csv", "w", "string")}
    totals = group_folder_job(spark, str(source), str(tmp_path / "out"), strict=True).first()
    assert totals["files"] == 4


def test_streams_of_folders_below(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "sub" / "a.csv").write_text("id\n1\n")
    write_workbook(tmp_path / "in" / "sub" / "w.xlsx", {"S": [["Id"], [3]]})
    stream = csv_stream(spark, str(tmp_path / "in"), "id int").filter("source_file like '%.csv'")
    run_available(stream, str(tmp_path / "c1"), split_sink(str(tmp_path / "t"), str(tmp_path / "q")))
    assert [r.id for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [1]
    found = []
    run_available(grid_stream(spark, str(tmp_path / "in")), str(tmp_path / "c2"), lambda batch, _: found.append(batch.count()))
    assert sum(found) == 2
