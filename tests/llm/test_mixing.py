"""Mixing against a plain computation in hash order."""

import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import mixing

SCHEMA = "doc_id long, text string, source string, size int, no string"


def cycle(sources):
    return sources.withColumn("weight", (F.col("no") - 1) % 3 + 1)


def size_of(text):
    return len((text or "").encode().split())


def brute(rows, most=3, total=None, seed="mix"):
    sizes = defaultdict(int)
    for _, text, source, *_ in rows:
        sizes[source] += size_of(text)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_, rest = {}, set(order), sum(sizes.values())
    rest = rest if total is None else min(total, most * rest)
    while open_:
        level = Fraction(rest, sum(weight[s] for s in open_))
        full = {s for s in open_ if weight[s] * level > most * sizes[s]}
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        target |= {s: Fraction(most * sizes[s]) for s in full}
        rest -= sum(most * sizes[s] for s in full)
        open_ -= full
    out = []
    for source in order:
        repeats = int(target[source] // sizes[source]) if sizes[source] else 0
        budget, before = target[source] - repeats * sizes[source], 0
        own = [(int(hashlib.sha256(f"{seed}:{'' if k is None else k}".encode()).hexdigest()[:12], 16), size_of(t), k)
               for k, t, s, *_ in rows if s == source]
        for _, size, key in sorted(own, key=lambda x: x[:2]):
            once = before + Fraction(size, 2) <= budget
            before += size
            out.append((key, source, size, sizes[source], round(float(target[source]), 6), size * (repeats + once)))
    return Counter(out)


def found(df):
    return Counter((*r[:4], round(r[4], 6), r[5]) for r in df.collect())


def documents(dice, rows, sources):
    return [(i, "w " * int(dice.integers(0, 40)), sources[int(dice.integers(len(sources)))], 1, "x") for i in range(rows)]


@pytest.mark.parametrize("case", range(4))
def test_brute_force(spark, case):
    dice = np.random.default_rng(case)
    rows = documents(dice, 300, ["b", "a", "ä", "Z", None, "b"] if case else ["s0"])
    rows += [(1_000 + i, "w\u00a0w w\tw\x0bw", "tiny", 1, "x") for i in range(2)] + [(2_000, None, "none", 1, "x"), (2_001, "", "none", 1, "x")]
    rows += [(3_000, "word " * 5_000, "b", 1, "x"), (None, "a b c", "a", 1, "x"), (None, "a b c", "a", 1, "x"), (None, "a", "a", 1, "x")]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(4), cycle)
    assert got.columns == ["doc_id", "source", "size", "source_size", "target", "taken"]
    assert found(got) == brute(rows)
    assert sum(n * r[5] <= 3 * n * r[2] for r, n in found(got).items()) == len(found(got))


@pytest.mark.parametrize("most, total", [(1, None), (1, 500), (2, 10**9), (3, 0)])
def test_limits(spark, most, total):
    rows = documents(np.random.default_rng(9), 200, ["a", "b", "c", "d"])
    assert found(mixing.mix(spark.createDataFrame(rows, SCHEMA), cycle, most=most, total=total)) == brute(rows, most, total)


def test_one_id_on_many_rows(spark):
    """The budget ends among rows that hash alike: as many of them as fit are taken, though no hash tells them apart."""
    rows = [(5, "a b", "s", 1, "x")] * 900 + [(5, "a", "s", 1, "x")] * 30 + [(6, "a b c", "t", 1, "x")] * 3_000
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA).repartition(6), cycle)
    assert found(got) == brute(rows)


def test_nested(spark):
    """What a smaller budget takes, a larger one takes as well."""
    df = spark.createDataFrame(documents(np.random.default_rng(2), 300, ["a", "b"]), SCHEMA)
    last = {}
    for total in (300, 1_500, 3_000, 6_000):
        taken = {r["doc_id"]: r["taken"] for r in mixing.mix(df, cycle, total=total).collect()}
        assert all(taken[k] >= n for k, n in last.items())
        last = taken


def test_many_sources(spark, monkeypatch):
    """Joined instead of sent to every task."""
    monkeypatch.setattr(mixing, "FEW", 0)
    rows = documents(np.random.default_rng(5), 400, [f"s{i}" for i in range(60)] + [None])
    assert found(mixing.mix(spark.createDataFrame(rows, SCHEMA), cycle)) == brute(rows)


def test_none(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA), cycle).count() == 0
    got = mixing.mix(spark.createDataFrame([(1, None, None, 1, "x"), (1, " ", "a", 1, "x")], SCHEMA), cycle)
    assert found(got) == Counter({(1, None, 0, 0, 0.0, 0): 1, (1, "a", 0, 0, 0.0, 0): 1})
