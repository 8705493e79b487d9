"""Minimal workbooks for tests: shared and inline strings, numbers, dates, sparse cells."""

from __future__ import annotations

import zipfile
from xml.sax.saxutils import escape

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
REL = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'


class Date(float):
    """A serial number shown as a date."""


def _letters(index: int) -> str:
    out = ""
    index += 1
    while index:
        index, rest = divmod(index - 1, 26)
        out = chr(65 + rest) + out
    return out


def write_workbook(path, sheets: dict[str, list[list]]) -> None:
    """Sheets by name; None is an absent cell, an empty row is left out of the file."""
    texts: list[str] = []

    def cell(row: int, col: int, value) -> str:
        ref = f"{_letters(col)}{row + 1}"
        if value is None:
            return ""
        if isinstance(value, bool):
            return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
        if isinstance(value, Date):
            return f'<c r="{ref}" s="1"><v>{float(value)}</v></c>'
        if isinstance(value, (int, float)):
            return f'<c r="{ref}"><v>{value}</v></c>'
        if col % 2:
            return f'<c r="{ref}" t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        if value not in texts:
            texts.append(value)
        return f'<c r="{ref}" t="s"><v>{texts.index(value)}</v></c>'

    parts = {}
    for n, rows in enumerate(sheets.values(), start=1):
        body = "".join(
            f'<row r="{i + 1}">' + "".join(cell(i, j, v) for j, v in enumerate(row)) + "</row>"
            for i, row in enumerate(rows)
            if row
        )
        parts[f"xl/worksheets/sheet{n}.xml"] = f"<worksheet {MAIN}><sheetData>{body}</sheetData></worksheet>"
    listed = "".join(f'<sheet name="{escape(s)}" sheetId="{n}" r:id="rId{n}"/>' for n, s in enumerate(sheets, 1))
    parts["xl/workbook.xml"] = f"<workbook {MAIN} {REL}><sheets>{listed}</sheets></workbook>"
    links = "".join(f'<Relationship Id="rId{n}" Target="worksheets/sheet{n}.xml"/>' for n in range(1, len(sheets) + 1))
    parts["xl/_rels/workbook.xml.rels"] = f"<Relationships>{links}</Relationships>"
    strings = "".join(f'<si><t xml:space="preserve">{escape(x)}</t></si>' for x in texts)
    parts["xl/sharedStrings.xml"] = f"<sst {MAIN}>{strings}</sst>"
    parts["xl/styles.xml"] = f'<styleSheet {MAIN}><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>'
    with zipfile.ZipFile(path, "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)


def write_half_broken(path) -> None:
    """A workbook whose only sheet refers to a shared text that is not there, after some sound rows."""
    write_workbook(path, {"S": [["a"], ["b"], ["c"]]})
    with zipfile.ZipFile(path) as book:
        parts = {n: book.read(n) for n in book.namelist()}
    sheet = "xl/worksheets/sheet1.xml"
    parts[sheet] = parts[sheet].replace(b"<v>2</v>", b"<v>99</v>")
    with zipfile.ZipFile(path, "w") as book:
        for name, text in parts.items():
            book.writestr(name, text)


GRID = "file_path string, sheet_no int, sheet string, row_idx int, cells array<string>"


def grid(spark, files: dict[str, list[list]]):
    """Cell grid of first sheets without going through a file."""
    rows = [(path, 0, "S", i, list(row)) for path, sheet in files.items() for i, row in enumerate(sheet)]
    return spark.createDataFrame(rows, GRID)
