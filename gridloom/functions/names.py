"""Column and file names: normalising, making unique, deriving safe forms."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def snake(name: Column) -> Column:
    """Lower case, every run of characters outside a-z and 0-9 to one underscore, ends stripped."""
    runs = F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_")
    return F.regexp_replace(runs, "^_+|_+$", "")


def sanitize(name: Column) -> Column:
    """Readable identifier: ``(%)`` becomes ``_pct``, separators underscores, the rest is dropped."""
    out = F.replace(name, F.lit("(%)"), F.lit("_pct"))
    out = F.regexp_replace(out, r"[ ,;{}()\n\t=/%\-]+", "_")
    out = F.regexp_replace(out, "[^A-Za-z0-9_]+", "")
    out = F.regexp_replace(F.regexp_replace(out, "_+", "_"), "^_+|_+$", "")
    return F.lower(F.when(out == "", F.lit("unnamed_col")).otherwise(out))


def schema_name(name: Column) -> Column:
    """Column name as used inside a schema fingerprint."""
    return F.regexp_replace(F.trim(F.lower(name)), "[^a-zA-Z0-9]", "_")


def uniquify(catalog: DataFrame, table: list[str], name: str, ordinal: str, out: str) -> DataFrame:
    """Second and later uses of a name within a table get ``__dup1``, ``__dup2`` and so on.

    A group holds the columns of one table that share a name, so it is as small as a header.
    """
    seen = F.row_number().over(Window.partitionBy(*table, name).orderBy(ordinal)) - 1
    return catalog.withColumn(
        out, F.when(seen == 0, F.col(name)).otherwise(F.concat(F.col(name), F.lit("__dup"), seen))
    )


def tidy_header(names: list[str]) -> list[str]:
    """``snake`` plus ``uniquify`` for one header that is already on the driver (column renames)."""
    seen: dict[str, int] = {}
    tidy = []
    for raw in names:
        base = re.sub("[^a-z0-9]+", "_", str(raw).lower()).strip("_")
        repeat = seen.get(base, 0)
        seen[base] = repeat + 1
        tidy.append(f"{base}__dup{repeat}" if repeat else base)
    return tidy


def extension(name: Column) -> Column:
    """Last suffix with its dot; empty when there is none or only dots stand before it."""
    found = F.instr(F.ltrim(name, F.lit(".")), ".") > 0
    return F.when(found, F.concat(F.lit("."), F.substring_index(name, ".", -1))).when(name.isNotNull(), F.lit(""))


def safe_file_name(name: Column) -> Column:
    """Names with non-ASCII characters or more than 150 characters become md5 plus extension."""
    awkward = name.rlike(r"[^\x00-\x7F]") | (F.length(name) > 150)
    return F.when(awkward, F.concat(F.md5(F.encode(name, "UTF-8")), extension(name))).otherwise(name)


def normalise_typography(text: Column) -> Column:
    """Curly quotes and long dashes to their keyboard forms."""
    return F.translate(text, "’‘”“–—", "''\"\"--")
