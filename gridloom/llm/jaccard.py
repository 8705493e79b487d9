"""Exact n-gram Jaccard join with filters under several global orders, and its connected components.

Texts become sets of word shingles; texts with equal sets are one class from the start. Two sets of a Jaccard
similarity of t or more share a token among the first (1 - t) of their tokens, whatever order all tokens are put in. So

1. a first prefix of every class, frequent shingles last, shows which shingles several classes have in it; a class
   without one has no partner and leaves;
2. the classes left are put in three orders anew, all with the shared shingles behind the others: under the first,
   classes that share a prefix token are candidates where their sizes fit and counts of their tokens in 64 hash ranges
   leave room for the overlap that is needed;
3. candidates have to share prefix tokens under the two other orders as well;
4. sets of what passes all filters are fetched and compared exactly.

Prefix tokens are counted in buckets: 32 bits of a rare one and 16 bits for its class within a block of classes are
shuffled, frequent ones are summed by Spark. Tokens that fall together look shared, which adds work and loses nothing.

Pairs are never listed for frequent tokens. Classes meet in the groups of their most frequent prefix tokens, in blocks
of bounded size, and a group returns no more links than it takes to connect its classes. A pair is looked at in the
first group that holds both; only pairs that no such group holds are listed. Frequencies serve the order alone: a rough count moves work about, not results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from gridloom.llm.batches import Memo, holding, slices, typed
from gridloom.llm.staging import staged

#: Counters of a task's frequency summary, frequent shingles that are put last, and hash ranges of a set's sketch.
COUNTERS, FREQUENT, RANGES = 400_000, 600_000, 64
#: Sets beyond this many shingles have no sketch; hash ranges of the finer sketch that is compared before sets.
SKETCHED, FINE = 1_000_000, 1_024
#: A token with more classes than BIG is compared in groups; classes join the groups of so many of theirs, in blocks.
BIG, HOMES, BLOCK = 64, 3, 512
#: Classes and about how many prefix tokens make a block (its classes are numbered in 16 bits); tokens a bucket counts.
PACKED, PACKED_TOKENS, COUNTED = 8_192, 400_000, 1_000_000
#: Numbers in the table of a matrix product.
PRODUCT = 2_000_000
#: Classes up to which the list of those to compare is broadcast (8 bytes each); beyond, it is joined.
LISTED = 1_000_000
WORDS = 300_000
_GROUPS = "group string, i int, j int, node long, side int, homes array<long>"
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


@dataclass(frozen=True)
class Rule:
    """Words of a shingle, and the least similarity as a fraction of whole numbers."""

    words: int
    share: int
    of: int

    def needed(self, a: Column, b: Column) -> Column:
        """Least overlap of sets of these sizes, rounded up."""
        return F.ceil((a + b) * self.share / (self.share + self.of) - 1e-9)

    def prefix(self, size: int) -> int:
        return size - -(-self.share * size // self.of) + 1


def mixed(tokens: np.ndarray, order: int) -> np.ndarray:
    """Places of tokens in a hash order."""
    x = (tokens ^ (tokens >> np.uint64(31))) * _MIX[order]
    return (x ^ (x >> np.uint64(29))) * _ODD


@lru_cache(maxsize=1)
def word_hashes() -> Memo:
    return Memo(lambda word: xxhash.xxh3_64_intdigest(word) >> 1, WORDS, "words")


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text: A-Z in lower case, words between ASCII white space. Fewer words
    than a shingle has are one sequence."""
    listed = text.encode("utf-8", "replace").lower().split()
    if not listed:
        return np.empty(0, "u8")
    hashes = np.fromiter(map(word_hashes().__getitem__, listed), "i8", len(listed)).view("u8")
    width = min(words, len(listed))
    found = np.full(len(listed) - width + 1, np.uint64(width))
    for i in range(width):
        found = (found ^ hashes[i:i + len(found)]) * _ODD
        found ^= found >> np.uint64(32)
    return np.unique(found)


def identity(tokens: np.ndarray, seed: int) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes(), seed) - 2**63


def sketch(tokens: np.ndarray, ranges: int) -> np.ndarray | None:
    """Numbers of tokens by hash range."""
    if len(tokens) > SKETCHED:
        return None
    return np.minimum(np.bincount(tokens & np.uint64(ranges - 1), minlength=ranges), 2**15 - 1).astype("i2")


class Frequencies:
    """Counts of frequent tokens with a bounded number of counters: when there are more, all go down by the same."""

    def __init__(self) -> None:
        self.tokens, self.counts = np.empty(0, "u8"), np.empty(0, "i8")
        self.waiting: list[np.ndarray] = []

    def add(self, sets: list[np.ndarray]) -> None:
        self.waiting += sets
        if sum(map(len, self.waiting)) > 2 * COUNTERS:
            self.sum_up()

    def sum_up(self) -> None:
        found, counts = np.unique(np.concatenate([*self.waiting, np.empty(0, "u8")]), return_counts=True)
        self.waiting = []
        tokens = np.concatenate([self.tokens, found])
        self.tokens, at = np.unique(tokens, return_inverse=True)
        self.counts = np.bincount(at, np.concatenate([self.counts, counts]), len(self.tokens)).astype("i8")
        if len(self.counts) > COUNTERS:
            least = np.partition(self.counts, -COUNTERS - 1)[-COUNTERS - 1]
            kept = self.counts > least
            self.tokens, self.counts = self.tokens[kept], self.counts[kept] - least


def classes(columns: DataFrame, rule: Rule, seed: int) -> DataFrame:
    """Staged rows of two kinds: (doc_id, size, node, digest) of every text, (token, n) of frequent tokens."""
    schema = "doc_id long, size long, node long, digest binary, token long, n long"

    def run(batches):
        holding("words")
        frequent, seen = Frequencies(), set()
        for part in slices(batches):
            sets = [shingles(x or "", rule.words) for x in part["t"]]
            nodes = [identity(s, seed) if len(s) else None for s in sets]
            # Copies count once, for the summary is about classes.
            fresh = {n: s for n, s in zip(nodes, sets) if n not in seen}
            seen.update(fresh)
            frequent.add([*fresh.values()])
            none = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(part["k"], pa.int64()), "size": [*map(len, sets)],
                "node": pa.array(nodes, pa.int64()),
                "digest": [xxhash.xxh3_128_digest(s.tobytes(), seed) for s in sets],
                "token": none, "n": none,
            })
        frequent.sum_up()
        kept = frequent.counts > 2
        rows = int(kept.sum())
        nothing = lambda kind: pa.nulls(rows, kind)
        yield pa.RecordBatch.from_pydict({
            "doc_id": nothing(pa.int64()), "size": nothing(pa.int64()), "node": nothing(pa.int64()),
            "digest": nothing(pa.binary()), "token": frequent.tokens[kept].view("i8"), "n": frequent.counts[kept],
        })

    return staged(columns.mapInArrow(typed(run, schema), schema))


def frequent_tokens(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent tokens and their counts (token, n), sorted by token; at most ``FREQUENT`` of them."""
    sums = counts.groupBy("token").agg(F.sum("n").alias("n"))
    listed = sums.orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    tokens, counts = (np.concatenate([*map(np.asarray, listed.column(c).chunks), np.empty(0, "i8")]) for c in ("token", "n"))
    order = np.argsort(tokens.view("u8"))
    return tokens.view("u8")[order], counts[order]


def weights_of(tokens: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Counts of frequent tokens, 0 for rare ones."""
    known, counts = frequent
    if not len(known):
        return np.zeros(len(tokens), "i8")
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    return np.where(known[at] == tokens, counts[at], 0)


def first_tokens(tokens: np.ndarray, count: int, weights: np.ndarray, order: int = 0) -> np.ndarray:
    """The first tokens under an order: rare ones by its hash, then frequent ones, by count under order 0 and by hash
    under the others."""
    rare = tokens[weights == 0]
    if len(rare) > count:
        return rare[np.argpartition(mixed(rare, order), count - 1)[:count]]
    rest, held = tokens[weights > 0], weights[weights > 0]
    places = mixed(rest, order)
    behind = np.lexsort((places, held)) if order == 0 else np.argsort(places)
    return np.concatenate([rare, rest[behind[:count - len(rare)]]])


def new_sets(batches, rule: Rule, seed: int):
    """Sets of a task's texts with their numbers, each class once."""
    seen: set[int] = set()
    for part in slices(batches):
        found: dict[int, np.ndarray] = {}
        for text in part["t"]:
            tokens = shingles(text or "", rule.words)
            if len(tokens) and (node := identity(tokens, seed)) not in seen:
                seen.add(node)
                found[node] = tokens
        yield found


def token_lists(rows: list[np.ndarray]) -> pa.Array:
    """The lower 32 bits of tokens."""
    starts = np.concatenate([[0], np.cumsum([len(x) for x in rows])]).astype("i4")
    low = np.concatenate([np.empty(0, "u8"), *rows]).astype("u4").view("i4")
    return pa.ListArray.from_arrays(pa.array(starts), pa.array(low))


def codes(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """Tokens as they are counted: the bucket, then 32 bits. Their order is that of tokens, so sorted ones are looked up
    beside each other."""
    high, low, count = tokens >> np.uint64(32), tokens & np.uint64(2**32 - 1), np.uint64(buckets)
    return high * count + (low * count >> np.uint64(32))


def code_of(token: Column, buckets: int) -> Column:
    """``codes`` of a column of tokens."""
    low = token.bitwiseAND(F.lit(2**32 - 1))
    return F.shiftrightunsigned(token, 32) * buckets + F.shiftright(low * buckets, 32)


def packed(prefixes: list[np.ndarray], buckets: int):
    """(bucket, tokens, owners): codes of a block's prefixes within their bucket and the places of their sets, as bytes."""
    found = codes(np.concatenate([np.empty(0, "u8"), *prefixes]), buckets)
    owners = np.repeat(np.arange(len(prefixes)), [len(x) for x in prefixes])
    order = np.argsort(found, kind="stable")
    found, owners = found[order], owners[order]
    once = np.ones(len(found), bool)
    once[1:] = (found[1:] != found[:-1]) | (owners[1:] != owners[:-1])
    found, owners = found[once], owners[once]
    ends = np.searchsorted(found, np.arange(1, buckets + 1, dtype="u8") << np.uint64(32))
    starts = np.concatenate([[0], ends[:-1]])
    low, owners = found.astype("<u4"), owners.astype("<u2")
    for bucket in np.flatnonzero(ends > starts):
        own = slice(starts[bucket], ends[bucket])
        yield int(bucket), low[own].tobytes(), owners[own].tobytes()


def prefixes(columns: DataFrame, rule: Rule, seed: int, frequent: tuple[np.ndarray, np.ndarray], buckets: int,
             traits: bool = False) -> DataFrame:
    """Staged prefixes under the first order; a class may come once from each task.

    Rows are of two kinds: (block, owner, node, size, sketch, held) of a class, with its frequent prefix tokens and, with
    ``traits``, its sketch; (block, bucket, tokens, owners) of the other tokens of a block of classes.
    """
    shared = columns.sparkSession.sparkContext.broadcast(frequent)
    schema = "block long, owner int, node long, size int, sketch array<smallint>, held array<long>, bucket int, tokens binary, owners binary"
    kinds = {"block": pa.int64(), "owner": pa.int32(), "node": pa.int64(), "size": pa.int32(),
             "sketch": pa.list_(pa.int16()), "held": pa.list_(pa.int64()), "bucket": pa.int32(),
             "tokens": pa.binary(), "owners": pa.binary()}

    def record(rows: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({k: pa.array(columns[k], t) if k in columns else pa.nulls(rows, t) for k, t in kinds.items()})

    def run(batches):
        block, rare = TaskContext.get().partitionId() << 24, []
        for found in new_sets(batches, rule, seed):
            if len(rare) + len(found) > PACKED or sum(map(len, rare)) > PACKED_TOKENS:
                for bucket, tokens, owners in packed(rare, buckets):
                    yield record(1, block=[block], bucket=[bucket], tokens=[tokens], owners=[owners])
                block, rare = block + 1, []
            held, sets = [], [*found.values()]
            for x in sets:
                weights = weights_of(codes(x, buckets), shared.value)
                count = rule.prefix(len(x))
                first = first_tokens(x, count, weights)
                known = min(count, int((weights == 0).sum()))
                rare.append(first[:known])
                held.append(-1 - codes(first[known:], buckets).astype("i8"))
            own = range(len(rare) - len(sets), len(rare))
            yield record(len(sets), block=[block] * len(sets), owner=own, node=[*found], size=[*map(len, sets)], held=held,
                         sketch=[sketch(x, RANGES) if traits else None for x in sets])
        for bucket, tokens, owners in packed(rare, buckets):
            yield record(1, block=[block], bucket=[bucket], tokens=[tokens], owners=[owners])

    return staged(columns.mapInArrow(typed(run, schema), schema))


def common(rows: pd.DataFrame) -> pd.DataFrame:
    """(block, owner, token, c) of a bucket's tokens that come more than once."""
    tokens = [np.frombuffer(x, "<u4") for x in rows["tokens"]]
    blocks = np.repeat(rows["block"].to_numpy(), [len(x) for x in tokens])
    owners = np.concatenate([np.frombuffer(x, "<u2") for x in rows["owners"]])
    found, at, counts = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    more = counts[at] > 1
    at = at[more]
    return pd.DataFrame({"block": blocks[more], "owner": owners[more].astype("i4"),
                         "token": found[at].astype("i8") | int(rows["bucket"].iloc[0]) << 32, "c": counts[at]})


def shared_tokens(prefix: DataFrame) -> DataFrame:
    """Staged (block, owner, token, c): prefix tokens that come more than once. Frequent ones are numbered below 0."""
    rare = prefix.filter("bucket is not null").select("bucket", "block", "tokens", "owners")
    rare = rare.groupBy("bucket").applyInPandas(common, "block long, owner int, token long, c long")
    held = prefix.filter("node is not null").select("block", "owner", F.explode("held").alias("token"))
    # There are no more of them than FREQUENT.
    counts = held.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    return staged(rare.unionByName(held.join(F.broadcast(counts), "token")))


def other_orders(columns: DataFrame, rule: Rule, seed: int, frequent: tuple[np.ndarray, np.ndarray], buckets: int,
                 nodes: DataFrame) -> DataFrame:
    """(node, second, third): prefixes under the two other orders of the classes in ``nodes`` (node, first), 32 bits a
    token."""
    shared = columns.sparkSession.sparkContext.broadcast(frequent)
    schema = "node long, second array<int>, third array<int>"

    def run(batches):
        for found in new_sets(batches, rule, seed):
            weights = [weights_of(codes(x, buckets), shared.value) for x in found.values()]
            second, third = ([first_tokens(x, rule.prefix(len(x)), w, k) for x, w in zip(found.values(), weights)] for k in (1, 2))
            yield pa.RecordBatch.from_pydict({
                "node": pa.array([*found], pa.int64()), "second": token_lists(second), "third": token_lists(third)})

    found = among(columns, nodes).mapInArrow(typed(run, schema), schema)
    return staged(found.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]))


def sets_of(columns: DataFrame, rule: Rule, seed: int, nodes: DataFrame) -> DataFrame:
    """(node, size, sketch, tokens) of the classes in ``nodes`` (node, first)."""
    schema = "node long, size int, sketch array<smallint>, tokens binary"

    def run(batches):
        for found in new_sets(batches, rule, seed):
            sets = found.values()
            yield pa.RecordBatch.from_pydict({
                "node": pa.array([*found], pa.int64()), "size": pa.array([*map(len, sets)], pa.int32()),
                "sketch": pa.array([sketch(x, FINE) for x in sets], pa.list_(pa.int16())),
                "tokens": pa.array([x.tobytes() for x in sets], pa.binary()),
            })

    found = among(columns, nodes).mapInArrow(typed(run, schema), schema)
    return staged(found.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"]))


def among(columns: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows that may hold the classes of ``nodes`` (node, first): those of the first ids, and those without an id.

    A long list of ids is not sent to every task, and no text is shuffled: then all rows stay.
    """
    ids = staged(nodes.select(F.col("first").alias("k")).filter("k is not null").distinct())
    if ids.count() > LISTED:
        return columns
    return columns.filter("k is not null").join(F.broadcast(ids), "k", "left_semi").unionByName(columns.filter("k is null"))


def listed(rows: DataFrame) -> DataFrame:
    """Stored rows, sent to every task where there are few."""
    return F.broadcast(rows) if rows.count() <= LISTED else rows


def may_link(rows: pd.DataFrame, rule: Rule) -> np.ndarray:
    """Which rows of a group have a partner by size and by the room that sketches leave.

    Two classes of several common homes are partners in the group of the lowest one alone.
    """
    side, size = rows["side"].to_numpy(), rows["size"].to_numpy().astype("i8")
    nodes, known = rows["node"].to_numpy(), rows["sketch"].notna().to_numpy()
    width = max(map(len, rows["sketch"][known]), default=1)
    sketches = np.full((len(rows), width), 2**15 - 1, "i2")
    if known.any():
        sketches[known] = np.stack(rows["sketch"][known].to_numpy())
    right = np.flatnonzero(side != 0)
    found = np.zeros(len(rows), bool)
    group, none = rows["group"].iloc[0], 2**63 - 1
    home = int(group[1:]) if group[0] == "t" else -none
    homes = np.full((len(rows), HOMES), none)
    if group[0] == "t":
        for r, x in enumerate(rows["homes"]):
            homes[r, :len(x)] = x
    for r in np.flatnonzero(side != 1):
        fits = (np.minimum(size[r], size[right]) * rule.of >= np.maximum(size[r], size[right]) * rule.share) & (nodes[right] != nodes[r])
        near = right[fits]
        for lower in homes[r][homes[r] < home]:
            near = near[(homes[near] != lower).all(axis=1)]
        room = np.minimum(sketches[near], sketches[r]).sum(axis=1, dtype="i8")
        room[~(known[near] & known[r])] = 2**40
        near = near[room * (rule.share + rule.of) >= (size[near] + size[r]) * rule.share]
        found[near] = True
        found[r] |= len(near) > 0
    return found


def compare(rows: pd.DataFrame, rule: Rule) -> list[tuple[int, int]]:
    """Links that connect the linked rows of a group: rows of side 0 meet those of side 1, rows of side 2 each other."""
    rows = rows.drop_duplicates(["side", "node"]).sort_values("node", kind="stable")
    sets = [np.frombuffer(x, "u8") for x in rows["tokens"]]
    side, nodes = rows["side"].to_numpy(), rows["node"].to_numpy()
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    sizes = np.array([*map(len, sets)], "i8")
    owner = np.repeat(np.arange(len(sets)), sizes)
    tokens, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = counts[column] > 1
    number = np.cumsum(counts > 1) - 1
    owner, column, tokens = owner[common], number[column[common]], tokens[counts > 1]
    small, large = np.minimum.outer(sizes[left], sizes[right]), np.maximum.outer(sizes[left], sizes[right])
    alive = small * rule.of >= large * rule.share
    alive &= nodes[left][:, None] != nodes[right][None, :]

    def products(chosen: np.ndarray) -> np.ndarray:
        """Numbers of chosen tokens that rows share."""
        total = np.zeros((len(left), len(right)), "f4")
        step = max(1, PRODUCT // max(1, len(sets)))
        own, at = owner[chosen], column[chosen]
        order = np.argsort(at, kind="stable")
        own, at = own[order], at[order]
        for start in range(0, len(tokens), step):
            a, b = np.searchsorted(at, [start, start + step])
            if a == b:
                continue
            table = np.zeros((len(sets), min(step, len(tokens) - start)), "f4")
            table[own[a:b], at[a:b] - start] = 1
            total += table[left] @ table[right].T
        return total

    for order in (1, 2):
        if not alive.any():
            return []
        first = np.zeros(len(owner), bool)
        for r, s in enumerate(sets):
            places, count = mixed(s, order), rule.prefix(len(s))
            last = np.partition(places, count - 1)[count - 1]
            own = np.flatnonzero(owner == r) if len(sets) < 3 else slice(*np.searchsorted(owner, [r, r + 1]))
            first[own] = mixed(tokens[column[own]], order) <= last
        alive &= products(first) > 0
    if not alive.any():
        return []
    shared = products(np.ones(len(owner), bool)).astype("i8")
    union = sizes[left][:, None] + sizes[right][None, :] - shared
    linked = alive & (shared * rule.of >= union * rule.share)
    parent = np.arange(len(sets))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(*np.nonzero(linked)):
        a, b = root(left[a]), root(right[b])
        parent[max(a, b)] = min(a, b)
    return [(int(nodes[root(x)]), int(nodes[x])) for x in range(len(sets)) if root(x) != x]


def fitting(rule: Rule):
    """Drops the rows of a group that have no partner in it, by sizes and sketches."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.loc[may_link(rows, rule), ["group", "i", "j", "node", "side", "homes"]]

    return fit


def candidates(signed: DataFrame, rule: Rule, other: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Groups to compare: (group, i, j, node, side, homes). ``other`` gives the prefixes under the other orders of some
    classes."""
    # A class may have come from several tasks.
    signed_once = signed.filter("node is not null").select("block", "owner", "node", "size", "sketch").dropDuplicates(["node"])
    shared = staged(shared_tokens(signed).join(signed_once.select("block", "owner", "node"), ["block", "owner"]).select("token", "node", "c"))
    # A class has as many rows as its prefix has tokens.
    top = F.slice(F.reverse(F.array_sort(F.collect_list(F.when(F.col("c") > BIG, F.struct("c", "token"))))), 1, HOMES)
    homes = staged(shared.groupBy("node").agg(top.alias("top")).select("node", F.col("top.token").alias("homes"),
                                                                     F.col("top.c").alias("sizes")))
    placed = homes.select("node", F.posexplode("homes").alias("at", "token"), "sizes", "homes").select(
        "node", "token", "homes", F.ceil(F.element_at("sizes", F.col("at") + 1) / BLOCK).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    partner = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    grouped = placed.select("node", "token", "homes", block.alias("own"), partner.alias("other")).select(
        F.concat(F.lit("t"), F.col("token").cast("string")).alias("group"),
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node",
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"), "homes")

    traits = staged(signed_once.join(homes.select("node"), "node", "left_semi").select("node", "size", "sketch"))
    grouped = grouped.join(traits, "node").groupBy("group", "i", "j").applyInPandas(fitting(rule), _GROUPS)
    # A token that is a home of both sides has brought them together already, so it joins the rows that have it as
    # another token with all rows, never all with all.
    full = shared.select("token", "node").join(homes.select("node", "homes"), "node").join(traits.select("node", "size"), "node")
    a, b = (full.select("token", *(F.col(x).alias(f"{x}_{s}") for x in ("node", "size", "homes"))) for s in "ab")
    at_home = F.array_contains(F.col("homes_b"), a["token"])
    pairs = a.filter(~F.array_contains("homes_a", F.col("token"))).join(b, [
        a["token"] == b["token"], (F.col("node_a") < F.col("node_b")) | (at_home & (F.col("node_a") != F.col("node_b"))),
        F.col("size_a") * rule.of >= F.col("size_b") * rule.share, F.col("size_b") * rule.of >= F.col("size_a") * rule.share,
        ~F.arrays_overlap("homes_a", "homes_b"),
    ]).select(F.least("node_a", "node_b").alias("node_a"), F.greatest("node_a", "node_b").alias("node_b")).distinct()
    # What both sides need is fetched once a pair: sketches first, then the prefixes of the other orders.
    a, b = (traits.select(*(F.col(x).alias(f"{x}_{s}") for x in ("node", "size", "sketch"))) for s in "ab")
    room = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    room = F.coalesce(room, F.least("size_a", "size_b"))
    pairs = pairs.join(a, "node_a").join(b, "node_b").filter(room >= rule.needed(F.col("size_a"), F.col("size_b")))
    pairs = staged(pairs.select("node_a", "node_b"))
    orders = other(pairs.select(F.col("node_a").alias("node")).union(pairs.select("node_b")).distinct())
    a, b = (orders.select(*(F.col(x).alias(f"{x}_{s}") for x in ("node", "second", "third"))) for s in "ab")
    pairs = pairs.join(a, "node_a").join(b, "node_b").filter(
        F.arrays_overlap("second_a", "second_b") & F.arrays_overlap("third_a", "third_b"))
    pairs = staged(pairs.select("node_a", "node_b"))
    parts = pairs.select("node_a", "node_b", F.pmod(F.xxhash64("node_b"), F.lit(BLOCK)).alias("part"))
    # Partners of a class go in as many groups as hash ranges that hold some; most have a single partner.
    few = parts.groupBy("node_a").agg(F.count(F.lit(1)).alias("n"))
    dealt = parts.join(few, "node_a").select(
        F.concat(F.lit("n"), F.col("node_a").cast("string")).alias("group"), "node_a", "node_b",
        F.pmod("part", F.ceil(F.col("n") / BLOCK)).cast("int").alias("i"))
    ahead = dealt.select("group", "i", F.lit(0).alias("j"), F.col("node_a").alias("node"), F.lit(0).alias("side")).distinct()
    behind = dealt.select("group", "i", F.lit(0).alias("j"), F.col("node_b").alias("node"), F.lit(1).alias("side"))
    return staged(grouped.unionByName(ahead, True).unionByName(behind, True))


def links(columns: DataFrame, rows: DataFrame, firsts: DataFrame, rule: Rule, seed: int) -> DataFrame:
    """(a, b): links between classes, as many as connect all that are linked."""
    heavy = rows.filter("token is not null").groupBy("token").agg(F.sum("n").alias("n")).filter("n >= 8")
    # Copies of a class add nothing: where they are few, their rows are left out from here on.
    copies = rows.filter("node is not null").join(firsts, "node").filter("doc_id <> first").select(F.col("doc_id").alias("k"))
    copies = staged(copies.distinct().join(firsts.select(F.col("first").alias("k")), "k", "left_anti"))
    if copies.count() <= LISTED:
        columns = columns.join(F.broadcast(copies), "k", "left_anti")
    # No text has more prefix tokens than this, whatever its size.
    most = rows.agg(F.sum(F.col("size") * (rule.of - rule.share) / rule.of + 1)).first()[0] or 0
    buckets = max(int(columns.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(most) // COUNTED + 1)
    heavy = heavy.groupBy(code_of(F.col("token"), buckets).alias("token")).agg(F.sum("n").alias("n"))
    prefix = prefixes(columns, rule, seed, frequent_tokens(heavy), buckets)
    again = shared_tokens(prefix)
    left = again.select("block", "owner").distinct().join(prefix.filter("node is not null"), ["block", "owner"])
    left = staged(left.select("node").distinct().join(firsts, "node"))
    # What turns out to be shared goes behind what may be rare, and prefixes of the classes left are taken once more.
    turned = again.groupBy("token").agg(F.max("c").alias("n"))
    turned = turned.select(F.when(F.col("token") < 0, -F.col("token") - 1).otherwise(F.col("token")).alias("token"), "n")
    behind = frequent_tokens(heavy.union(turned))
    signed = prefixes(among(columns, left), rule, seed, behind, buckets, traits=True)
    groups = candidates(signed, rule, lambda nodes: other_orders(columns, rule, seed, behind, buckets, nodes.join(firsts, "node")))
    sets = sets_of(columns, rule, seed, groups.select("node").distinct().join(firsts, "node"))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(compare(rows, rule), columns=["a", "b"], dtype="i8")

    # The finer sketch is a fraction of a large set, and few pairs of unlike sets pass it.
    finer = sets.select("node", "size", "sketch").join(listed(groups), "node")
    close = staged(finer.groupBy("group", "i", "j").applyInPandas(fitting(rule), _GROUPS))
    full = sets.select("node", "tokens").join(listed(close.drop("homes")), "node")
    return full.groupBy("group", "i", "j").applyInPandas(run, "a long, b long").distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex of edges (u, v), root being the smallest vertex of its component.

    Large-star and small-star steps in turn: each hangs neighbours on the smallest vertex near them, until nothing
    changes. Minima are taken before the shuffle, so a vertex with many neighbours costs no more than others.
    """
    edges = staged(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.filter("u <> v").distinct())
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(lowest)
        edges = staged(small.filter("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            return edges.select(F.col("u").alias("v"), F.col("v").alias("root"))
        state = tuple(now)


def near_duplicates(df: DataFrame, words: int = 5, share: int = 4, of: int = 5, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """doc_id, n_shingles (size of its set) and component_id of every row.

    Two texts link when of * intersection >= share * union of their sets of word shingles. component_id is the smallest
    doc_id that links reach. A text that is null or has no word has an empty set and stays alone. Rows that repeat a
    doc_id are one vertex, whatever their texts: what one of them links to, all do. Rows without a doc_id take part, each
    with its text; theirs is the component's id where a link reaches a doc_id, else null. Other columns are not read; an
    empty table gives no rows.
    """
    rule = Rule(words, share, of)
    columns = df.select(df[key].cast("long").alias("k"), df[text].cast("string").alias("t"))
    seed = 0
    while True:
        rows = classes(columns, rule, seed)
        documents = rows.filter("size is not null").select("doc_id", "size", "node", "digest")
        same = documents.filter("node is not null").groupBy("node").agg(
            F.min("doc_id").alias("first"), F.min("digest").alias("low"), F.max("digest").alias("high"))
        same = staged(same)
        # Two sets that share a 64-bit number call for other numbers.
        if same.filter("low <> high").isEmpty():
            break
        seed += 1
    firsts = same.select("node", "first")
    # Vertices are classes; the classes of one id hang together.
    placed = documents.filter("node is not null and doc_id is not null").select("doc_id", "node").distinct()
    unlike = placed.groupBy("doc_id").agg(F.min("node").alias("u"), F.max("node").alias("v")).filter("u < v")
    bound = placed.join(unlike.select("doc_id", "u"), "doc_id").select("u", F.col("node").alias("v"))
    found = links(columns, rows, firsts, rule, seed).select(F.col("a").alias("u"), F.col("b").alias("v"))
    roots = connected(found.union(bound))
    whole = firsts.join(roots, firsts["node"] == roots["v"], "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    whole = staged(whole)
    lowest = whole.groupBy("root").agg(F.min("first").alias("component"))
    heads = whole.join(lowest, "root").select("node", "component")
    return documents.select("doc_id", "size", "node").join(heads, "node", "left").select(
        "doc_id", F.col("size").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))
