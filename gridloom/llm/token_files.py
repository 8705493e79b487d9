"""Token ids of documents as flat binary files.

A part is a folder of three files: ``ids`` (unsigned integers, 16 bits wide where the vocabulary allows it, else 32,
little endian), ``offsets`` (unsigned 64-bit ends of its documents within the part) and ``docs`` (signed 64-bit document
ids). Parts follow each other in ascending document order. ``parts.npy`` holds one row per part: documents, tokens and
the number of tokens in all earlier parts, the prefix sum of their sizes. Readers map the files into memory.

Texts become ids where they are read; only ids are put in order, a few bytes a word. The folder has to be mounted on
driver and executors. A task writes a folder under a name of its own and renames it at the end, all files at once; the
order of documents is complete, so a repeated or doubled task leaves the same part.
"""

from __future__ import annotations

import os
import re
import shutil
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridloom.llm.batches import Recent, holding, slices, typed
from gridloom.llm.staging import mounted
from gridloom.llm.word_tokens import PRE_TOKEN, added_strings, is_plain, runs, tokenizer

RUNS, WORDS = 800_000, 1_000_000
#: A pre-token, or the line break between runs, which is in no pre-token.
WORD_OR_BREAK = re.compile(PRE_TOKEN.pattern + "|\n")
#: Keys a part from which borders of parts are taken.
SAMPLED = 100
#: Document id that stands for a null one in the files.
NO_ID = -(2**63)


class Encoder:
    """Ids of texts as bytes of the file format, from runs and words that are encoded once."""

    def __init__(self, path: str, width: int) -> None:
        self.library, self.added, self.kind = tokenizer(path), added_strings(path), f"<u{width}"
        self.words = Recent(self.packed, WORDS, "ids")
        self.runs = Recent(self.joined, RUNS, "ids")

    def packed(self, texts: list[str]) -> list[bytes]:
        """As the library has them, many in one call, without the places of tokens in the texts."""
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.kind).tobytes() for x in found]

    def joined(self, new: list[str]) -> list[bytes]:
        """Ids of runs: plain ones are parted into words by one search over all of them, the library takes the others."""
        found: dict[str, bytes] = {}
        added = [x for x in self.added if x in "\n".join(new)]
        plain = [x for x in new if is_plain(x) and not any(y in x for y in added)]
        parts = WORD_OR_BREAK.findall("\n".join(plain).lower())
        words = self.words.of({*parts} - {"\n"})
        own: list[bytes] = []
        runs = iter(plain)
        for part in parts + ["\n"] * bool(plain):
            if part == "\n":
                found[next(runs)] = b"".join(own)
                own = []
            else:
                own.append(words[part])
        odd = [x for x in new if x not in found]
        found.update(zip(odd, self.packed(odd)))
        return [found[x] for x in new]

    def encode(self, texts: list[str]) -> list[bytes]:
        listed = [runs(x) for x in texts]
        known = self.runs.of(set().union(*listed))
        return [b"".join(map(known.__getitem__, x)) for x in listed]


@lru_cache(maxsize=4)
def encoder(path: str, width: int) -> Encoder:
    return Encoder(path, width)


def id_width(path: str) -> int:
    return 2 if tokenizer(path).get_vocab_size() <= 2**16 else 4


def part_of(rows: DataFrame, count: int) -> Column:
    """The part of each row (k, t), so that parts follow each other in the order of keys and are of like size.

    Borders come from a sample of keys, before any text is encoded; rows with one key are parted by a hash of the text.
    """
    place = F.struct(F.col("k").isNotNull().alias("known"), F.coalesce("k", F.lit(0)).alias("k"), F.xxhash64("t").alias("hash"))
    share = min(1.0, SAMPLED * count / max(1, rows.count()))
    drawn = sorted(tuple(r[0]) for r in rows.filter(F.rand(1) < share).select(place).collect())
    borders = sorted({drawn[len(drawn) * i // count] for i in range(1, count)}) if drawn else []
    if not borders:
        return F.lit(0)
    kind = "array<struct<known:boolean,k:bigint,hash:bigint>>"
    listed = F.array(*[F.struct(*map(F.lit, x)) for x in borders]).cast(kind)
    return F.size(F.filter(listed, lambda x: x <= place))


def write_token_files(df: DataFrame, folder: str, path: str, end_id: int, parts: int | None = None,
                      key: str = "doc_id", text: str = "text") -> int:
    """Write every whole text's ids and ``end_id`` in ascending order of ``key``; returns the number of tokens.

    A null text is empty and gives the end id alone; a null key comes first; rows that share a key follow each other
    in the order of their ids as bytes. An empty table gives no parts. ``folder`` must be new.
    """
    at, width = mounted(folder), id_width(path)
    os.makedirs(at)
    spark = df.sparkSession
    count = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t"))
    placed = rows.withColumn("part", part_of(rows, count))

    def encode(batches):
        holding("ids")
        own = encoder(path, width)
        for part in slices(batches):
            yield pa.RecordBatch.from_pydict({
                "part": part["part"], "k": pa.array(part["k"], pa.int64()),
                "ids": pa.array(own.encode([x or "" for x in part["t"]]), pa.binary())})

    coded = placed.mapInArrow(typed(encode, "part int, k long, ids binary"), "part int, k long, ids binary")
    dealt = coded.repartitionById(count, "part").sortWithinPartitions("k", "ids").select("k", "ids")

    def run(batches):
        part = TaskContext.get().partitionId()
        end = np.array([end_id], f"<u{width}").tobytes()
        name, own = f"{at}/{part:06d}", f"{at}/.{part:06d}-{uuid.uuid4().hex}"
        os.makedirs(own)
        docs = tokens = 0
        with open(f"{own}/ids", "wb") as ids, open(f"{own}/offsets", "wb") as offsets, open(f"{own}/docs", "wb") as keys:
            for rows in slices(batches):
                ends = []
                for body in rows["ids"]:
                    ids.write(body)
                    ids.write(end)
                    tokens += len(body) // width + 1
                    ends.append(tokens)
                offsets.write(np.array(ends, "<u8").tobytes())
                keys.write(np.array([NO_ID if k is None else k for k in rows["k"]], "<i8").tobytes())
                docs += len(ends)
        publish(own, name)
        yield pa.RecordBatch.from_pydict({"part": [part], "docs": [docs], "tokens": [tokens]})

    # One row per part, so the driver holds as many numbers as there are parts.
    sizes = dealt.mapInArrow(typed(run, "part long, docs long, tokens long"), "part long, docs long, tokens long")
    table = np.array(sorted(tuple(r) for r in sizes.collect()), "<i8").reshape(-1, 3)
    bases = np.cumsum(table[:, 2]) - table[:, 2]
    np.save(f"{at}/parts.npy", np.column_stack([table, bases]))
    return int(table[:, 2].sum())


def publish(own: str, name: str) -> None:
    """Give a finished part its name; where another attempt of the task was first, its equal part stays."""
    try:
        os.rename(own, name)
    except OSError:
        if not os.path.isdir(name):
            raise
        shutil.rmtree(own)


def read_part(at: str, part: int, width: int):
    """Document ids, their ends and the ids of a part, mapped from its files."""
    def mapped(kind, dtype):
        name = f"{at}/{part:06d}/{kind}"
        return np.memmap(name, dtype, "r") if os.path.getsize(name) else np.empty(0, dtype)

    return mapped("docs", "<i8"), mapped("offsets", "<u8"), mapped("ids", f"<u{width}")


def read_token_files(spark: SparkSession, folder: str, path: str) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens and ids_crc32 (ids as little-endian 32-bit
    integers) of every document in the files, one task for each part."""
    at, width = mounted(folder), id_width(path)
    table = np.load(f"{at}/parts.npy")
    # A row per part goes out as a plain list: its length is the number of files.
    rows = [(int(p), int(base)) for p, docs, _, base in table if docs]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"

    def run(batches):
        for batch in batches:
            for part, base in zip(*(batch.column(i).to_pylist() for i in range(2))):
                docs, ends, ids = read_part(at, part, width)
                for first in range(0, len(docs), 4096):
                    keys, stops = docs[first:first + 4096], ends[first:first + 4096].astype("i8")
                    starts = np.concatenate([[ends[first - 1] if first else 0], stops[:-1]]).astype("i8")
                    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts, stops)]
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": [None if k == NO_ID else int(k) for k in keys],
                        "start": starts + base, "n_tokens": stops - starts, "ids_crc32": sums,
                    })

    files = spark.createDataFrame(rows, "part long, base long")
    return files.repartition(max(1, len(rows)), "part").mapInArrow(typed(run, schema), schema)
