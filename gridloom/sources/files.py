"""File listings."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import quote, unquote

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators.lineage import cut


def scanned_path() -> Column:
    """Path of the file a row was read from; Spark's metadata column holds it URL-encoded."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def glob_of(extension: str) -> str:
    """Glob for an extension in any case."""
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" for c in extension)


def literal(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\[\]{}*?])", r"\\\1", path)


def binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Files of a folder and of all folders below it."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    return reader.option("recursiveFileLookup", True).load(path)


def qualified_roots(spark: SparkSession, path: str) -> list[str]:
    """A path or glob as full paths, by the file system that Spark would use."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(conf).globStatus(place)
    if not found:
        raise FileNotFoundError(path)
    return [x.getPath().toString() for x in found]


def opened(path: str):
    """File system and inner path of a full path, for plain calls in tasks; an error where Arrow has no such system."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(quote(re.sub("^file:/+", "file:///", path), safe=":/@"))


def hidden(name: str) -> bool:
    """Names that Spark's scans pass over."""
    return name.startswith(".") or name.endswith("._COPYING_") or (
        name.startswith("_") and "=" not in name and name not in {"_metadata", "_common_metadata"})


def entries_of(path: str) -> list[tuple[str, int, bool]]:
    """Full path, length and whether it is a folder, of what a folder holds; of a file, the file itself."""
    from pyarrow.fs import FileSelector, FileType

    system, inner = opened(path)
    own = system.get_file_info(inner)
    found = system.get_file_info(FileSelector(inner)) if own.type == FileType.Directory else [own]
    lead = path.rstrip("/").removesuffix(inner.rstrip("/"))
    return [(lead + x.path, x.size or 0, x.type == FileType.Directory) for x in found if own is x or not hidden(x.base_name)]


def _listed(batches):
    for batch in batches:
        found = [x for path in batch["path"] for x in entries_of(path)]
        yield pd.DataFrame(found, columns=["path", "length", "folder"])


def matches(name: Column, glob: str) -> Column:
    """Whether a file name fits a glob of ``*``, ``?``, ``[...]`` and ``{a,b}``."""
    out, depth = "", 0
    for i, c in enumerate(glob):
        if c in "*?":
            out += "[^/]*" if c == "*" else "[^/]"
        elif c in "{}":
            depth += 1 if c == "{" else -1
            out += "(?:" if c == "{" else ")"
        elif c == "," and depth:
            out += "|"
        elif c == "!" and glob[i - 1:i] == "[":
            out += "^"
        else:
            out += c if c in "[]-^" else re.escape(c)
    return name.rlike(f"^(?:{out})\\z")


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path and length of every file of a folder and the folders below it, empty ones too; contents are not read.

    Folders are listed in tasks, level by level: a level's folders are dealt out, what they hold is stored, and the
    folders among it are the next level. The driver sees the roots and the number of folders. File systems that Arrow
    does not know are listed by Spark itself.
    """
    roots = qualified_roots(spark, path)
    try:
        opened(roots[0])
    except (pa.ArrowInvalid, NotImplementedError, OSError):
        return indexed_files(spark, path, glob)
    schema = "path string, length long, folder boolean"
    level = spark.createDataFrame([(p,) for p in roots], "path string")
    folders, parts = len(roots), []
    most = int(spark.conf.get("spark.sql.shuffle.partitions")) * 4
    while folders:
        found = cut(level.repartition(min(folders, most)).mapInPandas(_listed, schema))
        parts.append(found.filter("not folder").select("path", "length"))
        level = found.filter("folder").select("path")
        folders = level.count()
    return reduce(DataFrame.unionByName, parts).filter(matches(F.substring_index("path", "/", -1), glob))


def indexed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """The same from the index of a scan, which the driver holds.

    A scan passes over files without bytes, so those are added from its index.
    """
    files = binary_files(spark, path, glob)
    scanned = files.select("path", "length")
    indexed = spark.createDataFrame([(unquote(p),) for p in files.inputFiles()], "path string")

    def bare(column: str):
        return F.regexp_replace(column, "^([a-z0-9]+):/+", "$1:/")

    indexed = indexed.select(bare("path").alias("bare"), "path")
    seen = scanned.select(bare("path").alias("bare"))
    empty = indexed.join(seen, "bare", "left_anti").select(F.col("bare").alias("path"), F.lit(0).cast("long").alias("length"))
    return scanned.unionByName(empty)
