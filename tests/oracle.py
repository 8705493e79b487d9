"""Comparison of a Spark result with DuckDB on the same parquet tables."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        if isinstance(value, float) and math.isnan(value):
            return None
        return repr(round(float(value), 9) + 0.0)
    if type(value).__name__ == "Decimal":
        return repr(round(float(value), 9) + 0.0)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty text when both agree, otherwise what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    wanted = rows_of(names, cursor.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if got == wanted:
        return ""
    extra, missing = list((got - wanted).items())[:3], list((wanted - got).items())[:3]
    return f"{sum(got.values())} rows against {sum(wanted.values())}; only here {extra}; only there {missing}"
