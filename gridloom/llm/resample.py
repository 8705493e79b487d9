"""Importance resampling towards a target distribution of hashed n-grams, with segment deduplication.

Every text is cut into lines at newlines, which no word holds. A line that occurs many times in the corpus is counted
once: lines are grouped with their occurrences, the features inside each distinct line are worked out a single time
and weigh as often as the line occurs. N-grams that reach over the end of a line belong to no line; they are counted
apart, from the texts. Sums by bucket give the log ratio of target and corpus of each bucket, its gain. A text's weight
is the sum of its features' gains; seeded Gumbel noise by id makes the highest sums a draw without replacement, and
places come from ranges of the score, so nothing is sorted in one task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gridloom.llm.batches import Memo, holding, slices, typed
from gridloom.llm.ranks import numbered
from gridloom.llm.staging import staged
from gridloom.llm.terms import FOLDED, terms, utf8

#: Features whose bucket or gain a task remembers, and features counted before a task turns them into buckets.
REMEMBERED, HELD = 300_000, 300_000
_SUMS = "bucket int, n long"


def runs(words: list[bytes], longest: int, least: int = 1) -> Iterator[bytes]:
    """All runs of ``least`` to ``longest`` consecutive words, joined by blanks."""
    for n in range(least, longest + 1):
        yield from words if n == 1 else map(b" ".join, zip(*(words[i:] for i in range(n))))


def crossing(lines: list[list[bytes]], longest: int) -> Iterator[bytes]:
    """Runs that begin in one line and end in another."""
    if longest == 1 or len(lines) == 1:
        return
    words = [w for line in lines for w in line]
    owner = np.repeat(np.arange(len(lines)), [*map(len, lines)])
    for n in range(2, longest + 1):
        for i in np.flatnonzero(owner[:len(owner) - n + 1] != owner[n - 1:]):
            yield b" ".join(words[i:i + n])


def bucket_sums(columns: DataFrame, features: Callable[[dict], Iterable[tuple[Iterable[bytes], int]]], buckets: int) -> DataFrame:
    """(bucket, n): features by bucket. ``features`` gives lists of features, each with its weight, of a slice of rows."""

    def run(batches):
        counts: Counter = Counter()
        sums = np.zeros(buckets, "i8")

        def settle():
            at = np.fromiter((crc32(x) % buckets for x in counts), int, len(counts))
            np.add.at(sums, at, np.fromiter(counts.values(), "i8", len(counts)))
            counts.clear()

        for part in slices(batches):
            for found, times in features(part):
                if times == 1:
                    counts.update(found)
                else:
                    for feature, n in Counter(found).items():
                        counts[feature] += n * times
            if len(counts) > HELD:
                settle()
        settle()
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_pydict({"bucket": at, "n": sums[at]})

    return columns.mapInArrow(typed(run, _SUMS), _SUMS).groupBy("bucket").agg(F.sum("n").alias("n"))


def counted(df: DataFrame, text: str, longest: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket: distinct lines once, times their occurrences, and what crosses lines."""
    texts = df.select(df[text].cast("string").alias("text")).filter("text <> ''")
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).filter("line <> ''")
    lines = lines.groupBy("line").agg(F.count(F.lit(1)).alias("times"))

    def inside(part: dict):
        by_times: dict[int, list[bytes]] = {}
        for line, times in zip(part["line"], part["times"]):
            by_times.setdefault(times, []).append(line)
        for times, own in by_times.items():
            # Single words need no border between lines.
            found = terms(b" ".join(own)) if longest == 1 else (x for line in own for x in runs(terms(line), longest))
            yield found, times

    found = bucket_sums(lines.select(F.col("line").cast("binary").alias("line"), "times"), inside, buckets)
    if longest > 1:
        def between(part: dict):
            for own in part["text"]:
                yield crossing([terms(x) for x in own.split(b"\n")], longest), 1

        found = found.union(bucket_sums(texts.select(F.col("text").cast("binary").alias("text")), between, buckets))
    sums = np.zeros(buckets, "i8")
    for bucket, n in found.collect():  # one row a bucket and kind
        sums[bucket] += n
    return sums


def gains(target: np.ndarray, corpus: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((t + 1) * (S + B) / ((s + 1) * (T + B)))) of each bucket."""
    size = len(corpus)
    over, under = float(int(corpus.sum()) + size), float(int(target.sum()) + size)
    return np.array([math.floor(1000 * math.log((t + 1.0) * over / ((s + 1.0) * under)))
                     for t, s in zip(target.tolist(), corpus.tolist())], "i8")


def weighed(df: DataFrame, gain: np.ndarray, key: str, text: str, longest: int) -> DataFrame:
    """doc_id, n_words, n_features, weight of every text."""
    shared = df.sparkSession.sparkContext.broadcast(gain)  # one number a bucket
    schema = "doc_id long, n_words long, n_features long, weight long"

    def run(batches):
        holding("gains")
        own = shared.value.tolist()
        known = Memo(lambda x: own[crc32(x) % len(own)], REMEMBERED, "gains")
        for part in slices(batches):
            words, features, weights = [], [], []
            for one in part["t"]:
                listed = terms(one)
                words.append(len(listed))
                features.append(sum(max(0, len(listed) - n + 1) for n in range(1, longest + 1)))
                weights.append(sum(map(known.__getitem__, runs(listed, longest))))
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(part["k"], pa.int64()), "n_words": words, "n_features": features, "weight": weights})

    return df.select(df[key].cast("long").alias("k"), utf8(df, text).alias("t")).mapInArrow(typed(run, schema), schema)


def noise(key: Column, seed: int) -> Column:
    """Gumbel noise of an id in thousandths: floor(-1000 * ln(-ln(u))), u from the first 8 hex digits of a digest."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((number + 0.5) / F.lit(4294967296.0))))


def resample(df: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10, least: int = 20,
             seed: int = 2024, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row: rank is 1, 2, 3 … for the rows drawn, else null.

    Features are runs of 1 to ``longest`` words, repeats counted. Of the N rows of ``least`` words or more,
    floor(percent * N / 100) with the highest score are drawn, ties by smaller id. A null or empty text has no features
    and weight 0. Rows that repeat an id have the same noise and are rows of their own; of rows that tie in score and id
    the one of fewer features comes first. A null id counts as an empty one in the noise and as the largest in ties.
    An empty target gives gains of the corpus against a uniform one; an empty table gives no rows. Other columns are not
    read.
    """
    gain = gains(counted(target, text, longest, buckets), counted(df, text, longest, buckets))
    rows = staged(weighed(df, gain, key, text, longest).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    apt = rows.filter(F.col("n_words") >= least)
    drawn = percent * apt.count() // 100
    place = numbered(apt, [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")])
    ranked = place.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = rows.filter(F.col("n_words") < least).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).select("doc_id", "n_features", "weight", "score", "rank")
