"""The n-gram join against brute force over all pairs."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from gridloom.llm import jaccard

SCHEMA = "doc_id long, text string, node string, component_id string"


def brute(rows, words, share, of):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            same = rows[a][0] is not None and rows[a][0] == rows[b][0] and sets[a] and sets[b]
            both = len(sets[a] & sets[b])
            if same or both and both * of >= share * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    ids = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            ids[root(x)] = min(ids.get(root(x), i), i)
    return sorted(((i, len(s), ids.get(root(x)) if s else i) for x, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def corpus(seed):
    dice = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = [(None, "null id text here"), (900, None), (901, ""), (902, " \n\t"), (903, "one"), (904, "ONE"), (905, "one two"),
            (906, "One  two"), (907, "É one"), (908, "é one"), (909, "z " * 3000), (910, "z " * 2900), (911, "null id text here")]
    passage = dice.choices(vocabulary, k=30)
    for group in range(12):
        base = dice.choices(vocabulary, k=dice.randrange(20, 120))
        if group % 3 == 0:
            base[5:5] = passage
        for _ in range(dice.choice((1, 2, 5, 14))):
            copy = list(base)
            for _ in range(dice.choice((0, 0, 1, 1, 2, 3))):
                copy[dice.randrange(len(copy))] = dice.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    return rows + [rows[20], rows[21]]


@pytest.mark.parametrize("rule, limits", [((3, 90, 100), None), ((5, 4, 5), None), ((3, 90, 100), (2, 3, 1)), ((5, 4, 5), (1, 4, 0))])
def test_brute_force(spark, monkeypatch, rule, limits):
    if limits:
        for name, value in zip(("BIG", "BLOCK", "LISTED"), limits):
            monkeypatch.setattr(jaccard, name, value)
    rows = corpus(sum(rule))
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(4)
    got = sorted(map(tuple, jaccard.near_duplicates(df, *rule).collect()), key=repr)
    assert got == brute(rows, *rule)


def test_empty(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_connected_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100 - i, 100) for i in range(1, 20)] + [(7, 7)]
    got = {r.v: r.root for r in jaccard.connected(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 81 for i in range(82, 101)}}


def test_counters_keep_what_is_frequent(monkeypatch):
    import numpy as np

    monkeypatch.setattr(jaccard, "COUNTERS", 20)
    sums = jaccard.Frequencies()
    for i in range(200):
        sums.add([np.array([1, 2, 1000 + i], "u8"), np.array([1, 5000 + i], "u8")])
    assert {1, 2} <= set(sums.tokens.tolist()) and len(sums.tokens) <= 20


def components(spark, rows, **limits):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in jaccard.near_duplicates(df, 3, 90, 100).collect()), key=repr)


def test_a_text_without_an_id_links_others(spark):
    dice = random.Random(1)
    base = [f"w{dice.randrange(1000)}" for _ in range(60)]
    # The first and the last differ by too much, the one between is near to both.
    rows = [(3, " ".join(base)), (None, " ".join(base[:58])), (1, " ".join(base[:55])), (2, "other words all over")]
    assert components(spark, rows) == brute(rows, 3, 90, 100)
    assert {(i, c) for i, _, c in components(spark, rows)} == {(1, 1), (3, 1), (None, 1), (2, 2)}


def test_an_id_with_unlike_texts_is_one_vertex(spark):
    p, q = " ".join(f"p{i}" for i in range(30)), " ".join(f"q{i}" for i in range(30))
    rows = [(5, p), (5, q), (3, q), (6, p), (None, p), (7, ""), (5, "")]
    assert {(i, c) for i, _, c in components(spark, rows)} == {(3, 3), (5, 3), (6, 3), (None, 3), (7, 7), (5, 5)}
    assert components(spark, rows) == brute(rows, 3, 90, 100)


def test_prefixes_share_a_token_under_every_order():
    """Any two sets that link do, whatever the frequencies say."""
    import numpy as np

    dice, rule = np.random.default_rng(4), jaccard.Rule(3, 4, 5)
    for _ in range(200):
        whole = np.unique(dice.integers(0, 400, size=60).astype("u8"))
        a, b = (np.sort(dice.choice(whole, size=len(whole) - int(dice.integers(0, 6)), replace=False)) for _ in range(2))
        known = np.unique(dice.integers(0, 400, size=int(dice.integers(0, 300))).astype("u8"))
        frequent = known, dice.integers(1, 5, size=len(known))
        both = len(np.intersect1d(a, b))
        linked = both * rule.of >= rule.share * (len(a) + len(b) - both)
        for order in range(3):
            first = [jaccard.first_tokens(x, rule.prefix(len(x)), jaccard.weights_of(x, frequent), order) for x in (a, b)]
            assert [len(x) for x in first] == [rule.prefix(len(x)) for x in (a, b)]
            assert not linked or len(np.intersect1d(*first))


def test_prefix_tokens_are_counted_in_few_bytes():
    dice = np.random.default_rng(7)
    common = dice.integers(0, 2**64 - 1, 40, "u8")
    sets = [np.unique(np.concatenate([dice.integers(0, 2**64 - 1, 60, "u8"), dice.choice(common, 2)])) for _ in range(300)]
    rows = [(b, 5, t, o) for b, t, o in jaccard.packed(sets, 7)]
    assert sum(len(t) + len(o) for _, _, t, o in rows) == 6 * sum(map(len, sets))
    got = set()
    for bucket in range(7):
        own = pd.DataFrame([x for x in rows if x[0] == bucket], columns=["bucket", "block", "tokens", "owners"])
        got |= {tuple(map(int, x)) for x in jaccard.common(own).itertuples(index=False)}
    count = Counter(int(x) for s in sets for x in s)
    code = {x: int(jaccard.codes(np.array([x], "u8"), 7)[0]) for x in count}
    assert got == {(5, i, code[int(x)], count[int(x)]) for i, s in enumerate(sets) for x in s if count[int(x)] > 1}


def test_codes_keep_the_order_of_tokens(spark):
    tokens = np.unique(np.random.default_rng(5).integers(0, 2**64 - 1, 2000, "u8", endpoint=True))
    found = jaccard.codes(tokens, 51)
    assert (found[1:] >= found[:-1]).all() and found[-1] < 51 << 32
    rows = spark.createDataFrame([(int(x),) for x in tokens.view("i8")], "token long")
    assert [r[0] for r in rows.select(jaccard.code_of(rows.token, 51)).collect()] == found.tolist()


def test_a_pair_is_looked_at_in_one_home():
    sketch = np.full(64, 3, "i2")

    def found(group, homes):
        rows = pd.DataFrame({"group": group, "node": [1, 2], "side": 2, "size": 192, "sketch": [sketch] * 2, "homes": homes})
        return jaccard.may_link(rows, jaccard.Rule(5, 4, 5)).tolist()

    both = [[-5, 7, 9], [9, 7, -5]]
    assert [found(f"t{x}", both) for x in (-5, 7, 9)] == [[True] * 2, [False] * 2, [False] * 2]
    assert found("t7", [[3, 7, 9], [4, 7]]) == [True] * 2
    assert found("n7", [None, None]) == [True] * 2


def test_comparing_a_block_takes_little_memory():
    dice = np.random.default_rng(3)
    pairs = [dice.integers(0, 2**63, 200, "u8") for _ in range(512)]
    sets = [np.unique(np.concatenate([pairs[i // 2], dice.integers(0, 2**63, 4, "u8")])) for i in range(1024)]
    rows = pd.DataFrame({"node": range(1024), "side": [0, 1] * 512, "tokens": [x.tobytes() for x in sets]})
    tracemalloc.start()
    assert len(jaccard.compare(rows, jaccard.Rule(3, 90, 100))) == 512
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000, peak
