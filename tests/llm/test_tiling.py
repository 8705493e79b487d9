"""Greedy string tiling against its definition, and documents with benchmark passages."""

import random
import time

import numpy as np
import pytest

from gridloom.llm import tiling

SCHEMA = "doc_id long, text string, item_id string, coverage string"


def greedy(a, b, least):
    """The longest match of unmarked tokens again and again."""
    in_a, in_b, tiles = [False] * len(a), [False] * len(b), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not in_a[i + n] and not in_b[j + n]:
                    n += 1
                best = max(best, (n, -i, -j))
        if best[0] < least:
            return tiles
        n, i, j = best[0], -best[1], -best[2]
        in_a[i:i + n], in_b[j:j + n] = [True] * n, [True] * n
        tiles.append((i, j, n))


def seeds(a, b, least):
    return {(i, j) for i in range(len(a) - least + 1) for j in range(len(b) - least + 1) if a[i:i + least] == b[j:j + least]}


@pytest.mark.parametrize("seed", range(40))
def test_tiles(seed):
    dice = random.Random(seed)
    a, b = (dice.choices("abc" if seed % 2 else "abcdefgh", k=dice.randrange(5, 40)) for _ in range(2))
    for least in (2, 3, 4):
        assert tiling.tile(seeds(a, b, least), least, len(a), len(b)) == greedy(a, b, least)
        assert tiling.tile_rows(np.array(a), np.array(b), least) == greedy(a, b, least)


@pytest.fixture(scope="module")
def tables(spark):
    dice = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(dice.choices(words, k=30))) for i in range(20)] + [(50, None), (51, ""), (52, "!!"), (53, "Two words"), (1, "q r s t u v")]
    docs = []
    for i in range(60):
        own = dice.choices(words, k=dice.randrange(10, 200))
        if i % 3 == 0:
            item = items[i % 20][1].split()
            if i % 2:
                item = item[15:] + item[:15]
            own[5:5] = item
        docs.append((i, " ".join(own).capitalize()))
    docs += [(100, None), (101, ""), (102, "well, TWO -- words!"), (0, docs[0][1]), (None, "q r, s t u v"), (103, "two"), (104, "a b " * 5000)]
    rows = [(i, t, "x", "y") for i, t in docs]
    return docs, items, spark.createDataFrame(rows, SCHEMA).repartition(3), spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("chars, pairs", [(tiling.BLOCK_CHARS, tiling.PAIRS), (300, 20), (tiling.BLOCK_CHARS, 0)])
def test_documents(tables, monkeypatch, chars, pairs):
    monkeypatch.setattr(tiling, "PAIRS", pairs)
    docs, items, df, benchmark = tables
    want = []
    for i, text in docs:
        if i == 104:
            continue
        a = tiling.tokens(text or "")
        for j, item in items:
            b = tiling.tokens(item or "")
            least = min(tiling.SEED, len(b))
            tiles = greedy(a, b, least) if b else []
            matched = sum(n for *_, n in tiles)
            if matched and matched >= tiling.COVERAGE * len(b):
                want.append((i, j, len(b), matched, len(tiles), max(n for *_, n in tiles), matched / len(b)))
    got = [tuple(r) for r in tiling.contaminated(df, benchmark, block_chars=chars).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {i for i, *_ in want} == {i for i in range(0, 60, 3)} | {102, None}
    assert any(r[4] > 1 for r in want)


def test_empty(spark, tables):
    _, _, df, benchmark = tables
    assert tiling.contaminated(df.limit(0), benchmark).count() == 0
    assert tiling.contaminated(df, benchmark.limit(0)).count() == 0


def test_items_that_repeat_themselves():
    """Pairs of equal seeds are counted, not listed: their number is the product of both lengths."""
    items = [(1, "z " * 2_000), (2, "z z z z y"), (3, "a b c d e f"), (4, "z z z z " + "x " * 50)]
    block = tiling.Block(items, tiling.SEED)
    start = time.perf_counter()
    got = tiling.overlaps("z " * 20_000 + "a b c d e f", block, 0.5)
    assert time.perf_counter() - start < 5
    assert got == [(1, 2_000, 2_000, 1, 2_000, 1.0), (2, 5, 4, 1, 4, 0.8), (3, 6, 6, 1, 6, 1.0)]
    found = block.shared(np.array([block.numbers.get(t, 0) for t in tiling.tokens("z " * 20_000)], "u8"))
    assert found[0] == (4, None) and found[1][1] == {(d, 0) for d in range(19_997)}
