"""Top-k search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, score int"


def brute(rows, every, k):
    vectors = {}
    for i, v, _ in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        q = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        vectors[i] = min(vectors.get(i, q), q)
    out = []
    for i, q in vectors.items():
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in vectors.items() if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scores)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(2_048, 16_384, 2_048), (7, 40, 16)])
def test_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", blocks[1])
    dice = np.random.default_rng(4)
    centres = dice.normal(size=(6, 20))
    rows = [(i, [float(x) for x in centres[i % 6] + 0.3 * dice.normal(size=20)], 1) for i in range(300)]
    rows += [(1000 + i, rows[7][1], 1) for i in range(40)]
    rows += [(2000, None, 1), (2005, [], 1), (2010, [float("nan")] * 20, 1), (2015, [None] * 20, 1), (None, rows[3][1], 1),
             (2020, [0.5] * 3, 1), (2025, [0.0] * 20, 1), (5, rows[9][1], 1), (5, rows[5][1], 2), (2030, [float("inf")], 1)]
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA).repartition(5), F.col("vec_id") % 5 == 0, k=4).collect()
    assert sorted(map(tuple, got)) == brute(rows, 5, 4)


def test_few_and_none(spark):
    assert topk.top_k(spark.createDataFrame([], SCHEMA), F.lit(True)).count() == 0
    two = spark.createDataFrame([(1, [1.0], 0), (2, [-1.0], 0)], SCHEMA)
    got = topk.top_k(two, F.lit(True)).collect()
    assert sorted(map(tuple, got)) == [(1, 1, 2, -65536), (2, 1, 1, -65536)]


def test_bounds_hold():
    dice = np.random.default_rng(1)
    a, b = dice.normal(size=(50, 33)), dice.normal(size=(60, 33))
    last = None
    for segments in (1, 4, 16, 33):
        bound = topk.statistics(a, segments) @ topk.statistics(b, segments).T
        assert (bound >= a @ b.T - 1e-9).all()
        assert last is None or segments == 33 or bound.mean() < last
        last = bound.mean()


def test_large_components(spark):
    """Scores beyond what doubles hold exactly."""
    dice = np.random.default_rng(2)
    rows = [(i, [float(x) for x in dice.normal(size=6) * 1e6], 1) for i in range(60)]
    rows += [(100 + i, [1e6, 1e6, 1e6, 1e6, 1e6, 1e6 - i / 256 / 16], 1) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA.replace("float", "double"))
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=4).collect()
    exact = {i: [int(np.floor(256 * x)) for x in v] for i, v, _ in rows}
    wanted = []
    for i, q in exact.items():
        if i % 5 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in exact.items() if j != i)[:4]
            wanted += [(i, n + 1, j, -s) for n, (s, j) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(wanted)
    assert max(s for *_, s in wanted) > 2**53
