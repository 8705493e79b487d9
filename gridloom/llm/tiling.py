"""Benchmark decontamination by greedy string tiling.

A document and a benchmark item share a seed where ``SEED`` tokens in a row agree. Seeds are found by a running
Karp-Rabin hash over the document, looked up among the hashes of the benchmark and compared token by token. Seeds that
follow each other on a diagonal make matches. Greedy tiling takes the longest match, marks its tokens on both sides, cuts
what is left of the others and goes on, so passages count whatever their order. The share of an item's tokens that are
marked is its coverage.

Tasks look at whole documents against one block of the benchmark, whose size is bounded; a larger benchmark takes as
many passes as it has blocks. There is no shuffle.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gridloom.llm.batches import holding, slices, typed

#: Least length of a tile; an item with fewer tokens has to occur as a whole.
SEED = 4
#: Share of an item's tokens that tiles have to cover.
COVERAGE = 0.5
#: Pairs of seeds of a document and an item that are listed; with more, the item is walked token by token.
PAIRS = 100_000
#: Characters of benchmark text in a block, which is what a broadcast holds.
BLOCK_CHARS = 16_000_000
TOKEN = re.compile(r"[^\W_]+")
BASE = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "doc_id long, item_id long, item_tokens long, matched long, tiles long, longest long, coverage double"


def tokens(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


def running_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``length`` tokens."""
    found = np.zeros(max(len(ids) - length + 1, 0), "u8")
    for i in range(length):
        found = found * BASE + ids[i:i + len(found)]
    return found


class Block:
    """Benchmark items as numbered tokens, and the places of their seeds by hash."""

    def __init__(self, items: list[tuple[int, str]], seed: int) -> None:
        self.numbers: dict[str, int] = {}
        self.names, self.items = [], []
        places: dict[int, list[tuple[int, int, int]]] = {}
        for name, text in items:
            ids = np.array([self.numbers.setdefault(t, len(self.numbers) + 1) for t in tokens(text or "")], "u8")
            if not len(ids):
                continue
            length = min(seed, len(ids))
            for at, h in enumerate(running_hashes(ids, length).tolist()):
                places.setdefault(length, []).append((h, len(self.items), at))
            self.names.append(name)
            self.items.append(ids)
        #: By seed length: sorted hashes, and the (item, position) of each.
        self.seeds = {}
        for length, listed in places.items():
            table = np.array(sorted(listed), dtype=[("h", "u8"), ("item", "i8"), ("at", "i8")])
            self.seeds[length] = table["h"].copy(), table["item"].copy(), table["at"].copy()

        #: By seed length: the distinct hashes and items of the table, the place of each hash's first item, and how often
        #: an item has a hash.
        self.kinds = {}
        for length, (hashes, owners, _) in self.seeds.items():
            new = np.flatnonzero(np.diff(hashes, prepend=hashes[0] + np.uint64(1)) | (np.diff(owners, prepend=-1) != 0))
            self.kinds[length] = hashes[new], owners[new], np.diff(new, append=len(hashes))

    def shared(self, document: np.ndarray) -> dict[int, tuple[int, set[tuple[int, int]] | None]]:
        """By item, the seed length and the seeds (position in document, position in item) that it shares.

        Where the same tokens recur in document and item, pairs are counted before they are listed, and an item with more
        than ``PAIRS`` of them gets none listed.
        """
        found: dict[int, tuple[int, set | None]] = {}
        known = np.concatenate([[0], np.cumsum(document != 0)])
        for length, (hashes, items, places) in self.seeds.items():
            if len(document) < length:
                continue
            starts = np.flatnonzero(known[length:] - known[:-length] == length)
            windows = running_hashes(document, length)[starts]
            first, last = (np.searchsorted(hashes, windows, side) for side in ("left", "right"))
            many: set[int] = set()
            if (last - first).sum() > PAIRS:
                many = self.crowded(length, windows)
                found.update((item, (length, None)) for item in many)
            for i in np.flatnonzero(last > first):
                at = int(starts[i])
                for j in self.listed(items, first[i], last[i], many):
                    item, place = int(items[j]), int(places[j])
                    if np.array_equal(document[at:at + length], self.items[item][place:place + length]):
                        found.setdefault(item, (length, set()))[1].add((at, place))
        return found

    def crowded(self, length: int, windows: np.ndarray) -> set[int]:
        """Items that share more than ``PAIRS`` pairs of seeds with windows of a document."""
        hashes, items, times = self.kinds[length]
        distinct, repeats = np.unique(windows, return_counts=True)
        first, last = (np.searchsorted(hashes, distinct, side) for side in ("left", "right"))
        sizes = last - first
        at = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        pairs = np.bincount(items[at], times[at] * np.repeat(repeats, sizes), len(self.items))
        return set(np.flatnonzero(pairs > PAIRS).tolist())

    @staticmethod
    def listed(items: np.ndarray, first: int, last: int, many: set[int]):
        """Rows of a hash but for those of crowded items; rows of a hash are in the order of their items."""
        if not many:
            return range(first, last)
        rows: list[int] = []
        while first < last:
            end = first + int(np.searchsorted(items[first:last], items[first], "right"))
            if int(items[first]) not in many:
                rows.extend(range(first, end))
            first = end
        return rows


def tile_rows(document: np.ndarray, item: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """What ``tile`` gives, without a list of seeds: each pass walks the item token by token over the whole document,
    keeps the length of the unmarked match that ends at each place, and takes the longest ones that do not overlap.

    A pass costs document times item and needs memory for the document; there are as many as tiles differ in length.
    """
    in_document, in_item = np.zeros(len(document), bool), np.zeros(len(item), bool)
    tiles: list[tuple[int, int, int]] = []
    while True:
        best, ends = seed, []
        lengths = np.zeros(len(document) + 1, "i4")
        for i, token in enumerate(item):
            if in_item[i]:
                lengths[:] = 0
                continue
            grown = lengths[:-1] + 1
            grown[(document != token) | in_document] = 0
            lengths[1:] = grown
            longest = int(grown.max(initial=0))
            if longest > best:
                best, ends = longest, []
            if longest >= best:
                places = np.flatnonzero(grown == best) - best + 1
                ends.append(np.column_stack([places, np.full(len(places), i - best + 1)]))
        if not ends:
            return tiles
        starts = np.concatenate(ends)
        for d, i in starts[np.lexsort((starts[:, 1], starts[:, 0]))].tolist():
            if not in_document[d:d + best].any() and not in_item[i:i + best].any():
                in_document[d:d + best] = in_item[i:i + best] = True
                tiles.append((d, i, best))


def tile(seeds: set[tuple[int, int]], seed: int, document_size: int, item_size: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (position in document, position in item, length), the longest first, ties to the first positions."""
    queue = []
    for d, i in seeds:
        if (d - 1, i - 1) not in seeds:
            n = 1
            while (d + n, i + n) in seeds:
                n += 1
            heapq.heappush(queue, (-(n + seed - 1), d, i))
    in_document, in_item = np.zeros(document_size, bool), np.zeros(item_size, bool)
    tiles = []
    while queue:
        length, d, i = heapq.heappop(queue)
        length = -length
        taken = in_document[d:d + length] | in_item[i:i + length]
        if not taken.any():
            in_document[d:d + length] = in_item[i:i + length] = True
            tiles.append((d, i, length))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]])))
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= seed:
                heapq.heappush(queue, (-int(b - a), d + int(a), i + int(a)))
    return tiles


def overlaps(text: str, block: Block, coverage: float) -> list[tuple]:
    """Items that tiles of a text cover far enough: item, its tokens, marked tokens, tiles, longest tile, coverage."""
    get = block.numbers.get
    document = np.array([get(t, 0) for t in tokens(text)], "u8")
    out = []
    for item, (length, seeds) in sorted(block.shared(document).items()):
        size = len(block.items[item])
        if seeds is None:
            tiles = tile_rows(document, block.items[item], length)
            out += covered(block.names[item], size, tiles, coverage)
            continue
        # Seeds that touch too few of the item's tokens cannot cover it.
        touched = np.zeros(size + length, int)
        for place in {i for _, i in seeds}:
            touched[place] += 1
            touched[place + length] -= 1
        if np.count_nonzero(np.cumsum(touched)) < coverage * size:
            continue
        out += covered(block.names[item], size, tile(seeds, length, len(document), size), coverage)
    return out


def covered(name: int, size: int, tiles: list[tuple[int, int, int]], coverage: float) -> list[tuple]:
    matched = sum(n for _, _, n in tiles)
    if not tiles or matched < coverage * size:
        return []
    return [(name, size, matched, len(tiles), max(n for _, _, n in tiles), matched / size)]


def blocks_of(benchmark: DataFrame, chars: int = BLOCK_CHARS):
    """Lists of (item_id, text), each with about ``chars`` characters or one item; one at a time on the driver."""
    items = benchmark.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    items = items.filter("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = -(-total // chars)
    for n in range(count):
        part = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == n)
        yield [tuple(r) for r in part.orderBy("id", "text").collect()]


def contaminated(df: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED, key: str = "doc_id",
                 text: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row for each document and benchmark item that it covers to ``coverage`` or more, with the figures of the tiles.

    Tokens are lower-cased runs of letters and digits, in document and item alike. Texts and items that are null or
    have no token match nothing; an item shorter than ``seed`` tokens has to occur as a whole. Rows that repeat a
    document give its rows again; items that repeat count each. Other columns are not read; either table may be empty.
    """
    columns = df.select(df[key].cast("long").alias("k"), df[text].cast("string").alias("t"))
    out = None
    for items in blocks_of(benchmark, block_chars):
        shared = df.sparkSession.sparkContext.broadcast(Block(items, seed))

        def run(batches, shared=shared):
            holding("tiling")
            block = shared.value
            for part in slices(batches):
                rows = [(k, *x) for k, t in zip(part["k"], part["t"]) for x in overlaps(t or "", block, coverage)]
                yield pa.RecordBatch.from_pydict(dict(zip(
                    (f.split()[0] for f in SCHEMA.split(", ")), map(list, zip(*rows)) if rows else [[] for _ in range(7)],
                )))

        found = columns.mapInArrow(typed(run, SCHEMA), SCHEMA)
        out = found if out is None else out.union(found)
    return df.sparkSession.createDataFrame([], SCHEMA) if out is None else out
