"""Paths, URLs and the table names derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE_FOLDER = "^[0-9]{8}$"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def directory(path: Column) -> Column:
    """Everything before the last slash, ``.`` for a bare name."""
    return F.when(path.contains("/"), F.regexp_extract(path, "^(.*)/[^/]*$", 1)).otherwise(F.lit("."))


def drop_first_part(path: Column) -> Column:
    return F.regexp_replace(path, "^[^/]*/", "")


def suffix(path: Column) -> Column:
    """Lower-cased extension with its dot, empty when the name has none."""
    return F.lower(F.regexp_extract(base_name(path), r"(\.[^.]*)$", 1))


def strip_prefix(path: Column, prefix: str) -> Column:
    """Remove a leading folder prefix and the slash after it."""
    if not prefix:
        return path
    rest = F.substring(path, len(prefix) + 1, 1 << 30)
    return F.when(path.startswith(prefix), F.regexp_replace(rest, "^/", "")).otherwise(path)


def blob_name(line: Column, container: str) -> Column:
    """Name inside the container from a URL, a container path or a plain path."""
    text = F.regexp_replace(line, r"^\s+|\s+$", "")
    marker = f"/{container}/"
    at = F.locate(marker, text)
    inside = F.substring(text, at + F.lit(len(marker)), F.lit(1 << 30))
    from_url = F.when(at > 0, inside).otherwise(F.substring_index(text, "/", -1))
    return (
        F.when(text.contains("://"), from_url)
        .when(text.startswith(f"{container}/"), F.substring(text, len(container) + 2, 1 << 30))
        .otherwise(text)
    )


def storage_parts(uri: Column) -> Column:
    """``scheme://container@account.host/path`` as a struct of container, account and path."""
    shape = r"^[a-z]+://([^@/]+)@([^./]+)\.[^/]+/(.+)$"
    names = ["container", "account", "path"]
    return F.struct(
        *[F.nullif(F.regexp_extract(uri, shape, i + 1), F.lit("")).alias(n) for i, n in enumerate(names)]
    )


def site_parts(url: Column) -> Column:
    """Host and path of a site URL."""
    shape = "^https?://([^/]+)/(.*)$"
    return F.struct(
        F.regexp_extract(url, shape, 1).alias("host"), F.regexp_extract(url, shape, 2).alias("path")
    )


def percent_encode(text: Column, keep_slash: bool = True) -> Column:
    """RFC 3986 percent encoding; form encoding differs from it in four characters."""
    out = F.url_encode(text)
    fixes = [("+", "%20"), ("*", "%2A"), ("%7E", "~")] + ([("%2F", "/")] if keep_slash else [])
    for found, wanted in fixes:
        out = F.replace(out, F.lit(found), F.lit(wanted))
    return out


def share_token(url: Column) -> Column:
    """``u!`` and the unpadded URL-safe base64 of the address."""
    code = F.translate(F.base64(F.encode(url, "UTF-8")), "/+=\r\n", "_-")
    return F.concat(F.lit("u!"), code)


def _clean_table_name(name: Column) -> Column:
    out = F.regexp_replace(F.lower(name), "[^a-z0-9_]", "_")
    return F.regexp_replace(F.regexp_replace(out, "_+", "_"), "^_|_$", "")


def _parts(path: Column) -> Column:
    return F.split(path, "/")


def _named(name: Column) -> Column:
    clean = _clean_table_name(name)
    return F.when(clean == "", F.lit("unknown_table")).otherwise(clean)


def table_from_dated_path(path: Column) -> Column:
    """Folder before the first eight-digit folder, otherwise the last folder."""
    inner = F.regexp_replace(F.regexp_replace(path, "^[A-Za-z0-9]+://", ""), "^[^/]*/", "")
    inner = F.regexp_replace(F.regexp_replace(inner, r"/[^/]+\.[^/]+$", ""), "/$", "")
    parts = _parts(inner)
    dated = F.array_min(
        F.transform(parts, lambda p, i: F.when(p.rlike(DATE_FOLDER) & (i > 0), i))
    )
    return _named(F.when(dated.isNotNull(), F.get(parts, dated - 1)).otherwise(F.get(parts, F.size(parts) - 1)))


def table_from_leading_parts(path: Column) -> Column:
    """The two folders before a trailing eight-digit part, otherwise the first two parts."""
    bare = F.regexp_replace(F.regexp_replace(path, "^/", ""), "/$", "")
    parts = _parts(bare)
    n = F.size(parts)
    dated = (n >= 3) & F.get(parts, n - 1).rlike(DATE_FOLDER)
    name = (
        F.when(bare == "", F.lit("root"))
        .when(dated, F.concat_ws("_", F.get(parts, n - 3), F.get(parts, n - 2)))
        .when(n >= 2, F.concat_ws("_", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))))
        .otherwise(F.get(parts, F.lit(0)))
    )
    return _clean_table_name(name)


def table_from_document(path: Column) -> Column:
    """Base name of a schema document without ``.json``."""
    return _named(F.regexp_replace(base_name(path), r"\.json$", ""))


def load_pattern(path: Column) -> Column:
    """Wildcard that loads a file's folder; a trailing date folder widens to ``*``."""
    folder = directory(path)
    dated = base_name(folder).rlike(DATE_FOLDER)
    wide = F.concat(F.regexp_extract(folder, "^(.*)/[^/]*$", 1), F.lit("/*/*"), suffix(path))
    return F.when(dated & folder.contains("/"), wide).otherwise(F.concat(folder, F.lit("/*"), suffix(path)))
