"""Ranked search against scoring every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom.llm import lexical

DOCS = "doc_id long, text string, score int, lead string, words string"
ITEMS = "item_id long, text string, rank int"
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counts = [(key, Counter(words_of(text))) for key, text, *_ in docs]
    number, length = sum(bool(c) for _, c in counts), sum(c.total() for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    weight = lambda w: math.floor(1000 * math.log((2 * number + 2) / (2 * df[w] + 1)))
    wanted = {}
    for key, text, *_ in items:
        wanted.setdefault(key, set()).update(words_of(text))
    out = []
    for key, words in wanted.items():
        scores = []
        for doc, c in counts:
            if c:
                m = 50 + 50 * c.total() * number // length
                scores.append((-sum(weight(w) * (10**9 * c[w] // (1000 * c[w] + 20 * m)) for w in words), doc is None, doc))
        scores = sorted((s for s in scores if s[0] < 0), key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        out += [(key, i + 1, s[2], -s[0]) for i, s in enumerate(scores)]
    return Counter(out)


def world(dice, rows, words):
    vocabulary = [f"w{i}" for i in range(words)]
    common = (1 / np.arange(1, words + 1)) / (1 / np.arange(1, words + 1)).sum()
    texts = [" ".join(dice.choice(vocabulary, p=common, size=int(n))) for n in dice.integers(0, 40, size=rows)]
    docs = [(i, t, 1, "x", "y") for i, t in enumerate(texts)]
    items = [(i, " ".join(dice.choice(vocabulary, size=6)), 1) for i in range(30)]
    return docs, items


@pytest.mark.parametrize("case", range(3))
def test_brute_force(spark, monkeypatch, case):
    if case:
        for name, n in zip(("BATCH", "NODE", "LEAF", "FAN", "AT_ONCE"), ((32, 8, 3, 2, 50), (64, 16, 16, 4, 7))[case - 1]):
            monkeypatch.setattr(lexical, name, n)
    docs, items = world(np.random.default_rng(case), 600, 150)
    docs += [(700 + i, docs[5][1], 1, "x", "y") for i in range(30)]
    docs += [(800, None, 1, "x", "y"), (801, "", None, None, None), (None, docs[9][1], 1, "x", "y"), (None, docs[9][1], 1, "x", "y"),
             (3, "w1 w2 W3_w4", 1, "x", "y"), (802, "w7 " * 3_000 + "ÄÖ　Ü", 1, "x", "y"), (803, " .!", 1, "x", "y")]
    items += [(40, None, 1), (41, "", 1), (None, "W1 w2;äö ÄÖ　Ü", 1), (2, "w1 nowhere", 1), (42, "nowhere", 1), (43, "w0 w0", 1)]
    got = lexical.search(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS), k=7)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert Counter(map(tuple, got.collect())) == brute(docs, items, 7)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_WORDS", 40)
    docs, items = world(np.random.default_rng(8), 200, 60)
    got = lexical.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), k=5)
    assert Counter(map(tuple, got.collect())) == brute(docs, items, 5)


def test_none(spark):
    docs, items = spark.createDataFrame([(1, "a", 1, "x", "y")], DOCS), spark.createDataFrame([(1, "a", 1)], ITEMS)
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
    assert [tuple(r) for r in lexical.search(docs, items).collect()] == [(1, 1, 1, 287 * 333_333)]


def test_whole_batches_are_left_out(monkeypatch):
    """Documents without hope cost one bound a node, not a score each."""
    seen = []
    plain = lexical.Search.leaf

    def leaf(self, ids, *rest):
        seen.append(len(ids))
        return plain(self, ids, *rest)

    monkeypatch.setattr(lexical.Search, "leaf", leaf)
    tree = lexical.item_tree([0, 1], [(np.array([0, 1]), np.array([900, 800])), (np.array([2]), np.array([700]))])
    search = lexical.Search(tree, 3, 2, np.zeros(2, "i8"), False)
    rows = [(np.array([0, 1]), np.array([10, 10]))] * 64 + [(np.array([0]), np.array([1]))] * (lexical.BATCH - 64)
    search.batch(np.arange(len(rows)), np.zeros(len(rows), bool), lexical.Lists.of(rows))
    search.settle()
    first = len(seen)
    assert search.weakest.tolist() == [17_000, 1]
    rest = rows[64:]
    search.batch(np.arange(len(rest)), np.zeros(len(rest), bool), lexical.Lists.of(rest))
    assert len(seen) == first
    assert sorted(zip(*(x.tolist() for x in search.best[:3]))) == [(0, 17_000, 0), (0, 17_000, 1)]


def test_products():
    dice = np.random.default_rng(0)
    rows = [(np.sort(dice.choice(50, size=n, replace=False)), dice.integers(0, 9, size=n)) for n in (3, 0, 7, 1, 0, 20, 0)]
    own, dense = lexical.Lists.of(rows), dice.integers(0, 9, size=(4, 50))
    wanted = np.array([[(d[w] * v).sum() for w, v in rows] for d in dense])
    assert (own.products(dense) == wanted).all()
    some = np.array([5, 1, 2])
    assert (own.part(some).products(dense) == wanted[:, some]).all()
