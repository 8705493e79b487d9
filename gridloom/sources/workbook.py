"""Workbooks as a cell grid: one row per sheet row, all values text.

Workbooks are read by Spark as binary files and unpacked in the tasks. A workbook is a zip archive,
so one file is one task's work. A workbook is read whole or not at all: one that fails anywhere gives a
single row with the error and no cells. Files beyond what a binary value can hold (2 GB) are
reported in the same way. The format itself bounds a sheet to 1 048 576 rows, which bounds every per-sheet window downstream.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from itertools import islice
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.names import snake, uniquify
from gridloom.sources.files import binary_files, list_files

GRID_SCHEMA = (
    "file_path string, sheet_no int, sheet string, row_idx int, cells array<string>, error string"
)
WORKBOOK_GLOB = "*.[xX][lL][sS]*"
# Longest binary value of a row; rows of a workbook held while it is not known to be sound.
SIZE_LIMIT = 2**31 - 1
ROWS_PER_BATCH, ROWS_HELD = 5_000, 50_000

# Leading bytes of the two workbook containers, built-in date formats.
OLE2_MAGIC = "D0CF11E0A1B11AE1"
ZIP_MAGIC = "504B0304"
DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _shared_texts(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    texts = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, node in ElementTree.iterparse(part):
            if _local(node.tag) == "si":
                texts.append(_rich_text(node))
                node.clear()
    return texts


def _rich_text(node: ElementTree.Element) -> str:
    """Text of a plain or rich string without phonetic hints."""
    out = []
    for child in node:
        if _local(child.tag) == "t":
            out.append(child.text or "")
        elif _local(child.tag) == "r":
            out.extend(t.text or "" for t in child if _local(t.tag) == "t")
    return "".join(out)


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Indexes of cell formats that show a number as a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = set()
    for node in root.iter():
        if _local(node.tag) == "numFmt":
            code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", node.get("formatCode", ""))
            if re.search("[dmyhs]", code, re.IGNORECASE):
                custom.add(int(node.get("numFmtId", "0")))
    formats = next((n for n in root if _local(n.tag) == "cellXfs"), [])
    ids = [int(x.get("numFmtId", "0")) for x in formats]
    return {i for i, fmt in enumerate(ids) if fmt in DATE_FORMATS or fmt in custom}


def _sheets(book: zipfile.ZipFile) -> tuple[list[tuple[str, str]], datetime]:
    """Sheet names with their parts in workbook order, and the day serial numbers count from."""
    links = {
        node.get("Id"): node.get("Target", "")
        for node in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    found, epoch = [], datetime(1899, 12, 30)
    for node in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _local(node.tag) == "workbookPr" and node.get("date1904") in ("1", "true"):
            epoch = datetime(1904, 1, 1)
        if _local(node.tag) == "sheet":
            link = next(v for k, v in node.attrib.items() if _local(k) == "id")
            target = links[link].lstrip("/")
            found.append((node.get("name", ""), target if target.startswith("xl/") else f"xl/{target}"))
    return found, epoch


def _column(reference: str) -> int:
    index = 0
    for letter in reference:
        if not letter.isalpha():
            break
        index = index * 26 + ord(letter.upper()) - 64
    return index - 1


def _number(text: str) -> str:
    value = float(text)
    if re.fullmatch(r"-?\d+", text):
        return str(int(text))
    return str(int(value)) if value.is_integer() and abs(value) < 1e15 and "." not in text else repr(value)


def _value(cell: ElementTree.Element, texts: list[str], dates: set[int], epoch: datetime) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        inline = next((n for n in cell if _local(n.tag) == "is"), None)
        return (_rich_text(inline) or None) if inline is not None else None
    raw = next((n.text for n in cell if _local(n.tag) == "v"), None)
    if raw is None or raw == "":
        return None
    if kind == "s":
        return texts[int(raw)] or None
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind == "e":
        return None if raw == "#N/A" else raw
    if kind == "n":
        if int(cell.get("s", "0")) in dates:
            return str((epoch + timedelta(days=float(raw))).replace(microsecond=0))
        return _number(raw)
    return raw


def _rows(book: zipfile.ZipFile, part: str, texts, dates, epoch) -> Iterator[tuple[int, list[str | None]]]:
    """Rows of one sheet in order; skipped row numbers come out as empty rows."""
    expected = 0
    with book.open(part) as stream:
        for _, node in ElementTree.iterparse(stream):
            if _local(node.tag) != "row":
                continue
            at = int(node.get("r", expected + 1)) - 1
            for blank in range(expected, at):
                yield blank, []
            cells: list[str | None] = []
            for cell in node:
                place = _column(cell.get("r", "")) if cell.get("r") else len(cells)
                cells.extend([None] * (place - len(cells)))
                cells.append(_value(cell, texts, dates, epoch))
            yield at, cells
            expected = at + 1
            node.clear()


def _unpacked(path: str, content: bytes, all_sheets: bool) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        sheets, epoch = _sheets(book)
        texts, dates = _shared_texts(book), _date_styles(book)
        for number, (name, part) in enumerate(sheets if all_sheets else sheets[:1]):
            for at, cells in _rows(book, part, texts, dates, epoch):
                yield path, number, name, at, cells, None


def unpack(path: str, content: bytes, all_sheets: bool) -> Iterator[tuple]:
    """Grid rows of one sound workbook; any other is one row with an error and no cells.

    Rows go out once the last one has been read. A workbook with more rows than are held is read twice.
    """
    rows = _unpacked(path, content, all_sheets)
    try:
        held = list(islice(rows, ROWS_HELD))
        more = sum(1 for _ in rows)
    except Exception as problem:
        yield path, None, None, None, None, f"{type(problem).__name__}: {problem}"
        return
    yield from held if not more else _unpacked(path, content, all_sheets)


def _grid_frames(all_sheets: bool):
    names = [field.split()[0] for field in GRID_SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                held = []
                for row in unpack(path, content, all_sheets):
                    held.append(row)
                    if len(held) == ROWS_PER_BATCH:
                        yield pd.DataFrame(held, columns=names)
                        held = []
                if held:
                    yield pd.DataFrame(held, columns=names)

    return run


def kind_of(content: Column) -> Column:
    """ole2, zip, html or unknown, by the leading bytes; markup is looked for in what is no container."""
    head = F.hex(F.substring(content, 1, 8))
    text = F.when(~head.startswith(ZIP_MAGIC) & (head != OLE2_MAGIC), F.lower(F.decode(content, "ISO-8859-1")))
    return (
        F.when(head == OLE2_MAGIC, "ole2")
        .when(head.startswith(ZIP_MAGIC), "zip")
        .when(text.contains("<table") | text.contains("<html"), "html")
        .otherwise("unknown")
    )


def file_kind(spark: SparkSession, path: str, glob: str = "*", size_limit: int = SIZE_LIMIT) -> DataFrame:
    """Label files by leading bytes: empty, ole2, zip, html or unknown, with a flag for tiny ones."""
    files = binary_files(spark, path, glob).filter(F.col("length") <= size_limit)
    opened = files.select("path", "length", kind_of(F.col("content")).alias("kind"))
    unopened = F.when(F.col("length") == 0, "empty").when(F.col("length") > size_limit, "too large")
    rest = list_files(spark, path, glob).withColumn("kind", unopened).filter("kind is not null")
    return opened.unionByName(rest).withColumn("tiny", F.col("length").between(1, 99))


def read_grid(
    spark: SparkSession, path: str, all_sheets: bool = False, size_limit: int = SIZE_LIMIT, glob: str = WORKBOOK_GLOB
) -> DataFrame:
    """Cell grid of the workbooks under a path; trouble shows up as rows with ``error`` set."""
    return grid_of(binary_files(spark, path, glob), all_sheets, size_limit)


def grid_of(files: DataFrame, all_sheets: bool = False, size_limit: int = SIZE_LIMIT) -> DataFrame:
    """Cell grid of binary files, static or streaming."""
    inside = files.filter(F.col("length") <= size_limit).select("path", "content")
    grid = inside.mapInPandas(_grid_frames(all_sheets), GRID_SCHEMA)
    nothing = {f.name: f.dataType for f in grid.schema.fields}
    beyond = files.filter(F.col("length") > size_limit).select(
        F.col("path").alias("file_path"),
        *[F.lit(None).cast(nothing[c]).alias(c) for c in ("sheet_no", "sheet", "row_idx", "cells")],
        F.concat(F.lit("larger than the limit: "), F.col("length")).alias("error"),
    )
    return grid.unionByName(beyond)


def grid_rows(grid: DataFrame) -> DataFrame:
    return grid.filter("error is null").drop("error")


def grid_errors(grid: DataFrame) -> DataFrame:
    return grid.filter("error is not null").select("file_path", F.col("error").alias("reason"))


def grid_to_table(rows: DataFrame) -> DataFrame:
    """Sheets with a header row as one all-text table, columns united by tidy name.

    Only the distinct column names reach the driver; files of any header share one plan.
    """
    keys = ["file_path", "sheet_no"]
    heads = (
        rows.filter("row_idx = 0")
        .select(*keys, F.posexplode("cells").alias("pos", "raw"))
        .withColumn("raw", F.coalesce("raw", F.concat(F.lit("unnamed_"), F.col("pos").cast("string"))))
        .withColumn("base", snake(F.col("raw")))
    )
    heads = uniquify(heads, keys, "base", "pos", "name")
    names = [r["name"] for r in heads.groupBy("name").agg(F.min("pos").alias("p")).orderBy("p", "name").collect()]
    header = heads.groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("pos", "name")))["name"].alias("header")
    )
    body = rows.filter("row_idx > 0").join(header, keys)

    def cell(name: str):
        at = F.array_position("header", F.lit(name)).cast("int")
        return F.when(at > 0, F.get("cells", at - 1)).alias(name)

    return body.select("file_path", "row_idx", *[cell(n) for n in names])
