"""Resampling towards a target against a plain computation."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import resample

SCHEMA = "doc_id long, text string, rank string, _tie int"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def features(text, longest):
    words = words_of(text)
    return [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(docs, target, longest, buckets, percent, least, seed):
    bucket = lambda x: crc32(x.encode()) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in features(x, longest)) for texts in ([d[1] for d in docs], target))
    big, small = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * big / ((s[b] + 1) * small)))
    rows = []
    for key, text, *_ in docs:
        own = features(text, longest)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain(bucket(f)) for f in own)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append((key, len(own), weight, score, len(words_of(text)) >= least))
    apt = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = percent * len(apt) // 100
    out = [(*r[:4], i + 1 if i < drawn else None) for i, r in enumerate(apt)]
    return Counter(out + [(*r[:4], None) for r in rows if not r[4]])


def corpus(dice, rows):
    vocabulary = ["Alpha", "beta", "gämma", "δ", "x9", "the", "of", "a" * 80, "日本", "end."]
    lines = [" ".join(dice.choice(vocabulary, size=dice.integers(1, 9))) for _ in range(30)]
    return [(i, "\n".join(dice.choice(lines, size=dice.integers(1, 7))), "x", i) for i in range(rows)]


@pytest.mark.parametrize("longest, buckets, least", [(1, 10_000, 8), (2, 97, 3), (3, 11, 0)])
def test_brute_force(spark, longest, buckets, least):
    dice = np.random.default_rng(longest)
    docs = corpus(dice, 120)
    docs += [(500, None, "x", 1), (501, "", "x", 1), (502, " \n\n;", None, None), (None, docs[3][1], "x", 1), (None, docs[3][1], "x", 2),
             (7, docs[9][1], "x", 1), (7, docs[9][1], "x", 1), (504, "\nthe\n\nof\r\nthe", "x", 1)]
    target = [docs[0][1], "the of\nthe of", None, ""]
    got = resample.resample(
        spark.createDataFrame(docs, SCHEMA).repartition(5),
        spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"),
        longest=longest, buckets=buckets, percent=30, least=least, seed=5)
    assert Counter(map(tuple, got.collect())) == brute(docs, target, longest, buckets, 30, least, 5)


def test_lines_that_repeat_are_counted_once(spark, monkeypatch):
    """What is worked out are the distinct lines; runs over the ends of lines come from the texts."""
    docs = spark.createDataFrame([(i, "one two\nthree four", "x", 1) for i in range(50)], SCHEMA)
    sums = resample.counted(docs, "text", 2, 5_000)
    for feature, n in {"one": 50, "three four": 50, "two three": 50, "one three": 0}.items():
        assert sums[crc32(feature.encode()) % 5_000] == n
    assert sums.sum() == 50 * 7


def test_few_features_held(spark, monkeypatch):
    monkeypatch.setattr(resample, "HELD", 1)
    docs = corpus(np.random.default_rng(3), 40)
    df, target = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame([(1, docs[1][1])], "item_id long, text string")
    got = Counter(map(tuple, resample.resample(df, target, least=1).collect()))
    assert got == brute(docs, [docs[1][1]], 1, 10_000, 10, 1, 2024)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert resample.resample(none, items).count() == 0
    got = resample.resample(spark.createDataFrame([(1, "the the of", "x", 1)], SCHEMA), items.limit(0), percent=100, least=1)
    assert [r["rank"] for r in got.collect()] == [1]


def test_one_score_for_a_third_of_all_rows(spark):
    """Rows that tie in everything are numbered in several tasks, each place once."""
    df = spark.range(3_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("a b c").alias("text"))
    got = resample.resample(df, df.limit(1), percent=50, least=1)
    assert sorted(r["rank"] for r in got.filter("rank is not null").collect()) == [*range(1, 1_501)]
