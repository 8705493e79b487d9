"""Ranked lexical search by a dual tree: exact best documents of each item, whole batches pruned at once.

Documents become vectors over the items' words: the impact of each word they hold, an integer of its occurrences and
the document's length. They are ordered by their rarest such word and cut into batches, nodes and leaves; a node holds
the highest impact of each word below it. Items are ordered by their rarest word and form a tree of their own; a node
holds the highest weight of each word, and the weakest k-th score among its items. The product of both maxima bounds
every score between two nodes from above: pairs of nodes below that weakest score are left out with everything under
them. What is left is scored exactly, in integers.

Two rounds search all batches. In the first an item meets, in each batch, the node with the highest bound; what it
finds gives k-th scores that hold for every task of the second, which searches all the rest.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gridloom.llm.batches import slices, typed
from gridloom.llm.staging import staged
from gridloom.llm.terms import terms, utf8

#: Words of items (each item's own words added up) that one pass over the documents serves.
ITEM_WORDS = 1_000_000
#: Documents of a batch, of a node and of a leaf; children of a node of items.
BATCH, NODE, LEAF, FAN = 2_048, 256, 32, 8
#: Words times rows that are multiplied at once.
AT_ONCE = 2_000_000
_VECTOR = "doc_id long, n long, words array<int>, times array<int>"
_PLACED = "doc_id long, n long, lead int, words array<int>, impacts array<int>"
_FOUND = "item int, item_id long, doc_id long, score long"


def item_words(items: DataFrame, key: str, text: str) -> DataFrame:
    """item_id, words (distinct, sorted) of every item; rows that repeat an id are one item."""
    schema = "item_id long, words array<binary>"

    def run(batches):
        for part in slices(batches):
            yield pa.RecordBatch.from_pydict({
                "item_id": pa.array(part["k"], pa.int64()),
                "words": pa.array([sorted({*terms(x)}) for x in part["t"]], pa.list_(pa.binary()))})

    rows = items.select(items[key].cast("long").alias("k"), utf8(items, text).alias("t")).mapInArrow(typed(run, schema), schema)
    return rows.groupBy("item_id").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("words")))).alias("words"))


def vectors(documents: DataFrame, key: str, text: str, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (words with repeats) and the items' words in the text with their occurrences, of all documents."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)  # at most ITEM_WORDS words

    def run(batches):
        place = {x: i for i, x in enumerate(shared.value)}
        known = place.keys()
        for part in slices(batches):
            lengths, words, times = [], [], []
            for one in part["t"]:
                listed = terms(one)
                counts: dict[bytes, int] = {}
                for word in filter(known.__contains__, listed):
                    counts[word] = counts.get(word, 0) + 1
                lengths.append(len(listed))
                words.append([place[x] for x in counts])
                times.append([*counts.values()])
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(part["k"], pa.int64()), "n": pa.array(lengths, pa.int64()),
                "words": pa.array(words, pa.list_(pa.int32())), "times": pa.array(times, pa.list_(pa.int32()))})

    return documents.select(documents[key].cast("long").alias("k"), utf8(documents, text).alias("t")).mapInArrow(
        typed(run, _VECTOR), _VECTOR)


@dataclass
class Lists:
    """Rows of (word, value) pairs in one piece."""

    words: np.ndarray
    values: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[np.ndarray, np.ndarray]]) -> Lists:
        starts = np.concatenate([[0], np.cumsum([len(w) for w, _ in rows])]).astype("i8")
        words, values = (np.concatenate([np.empty(0, "i8"), *x]).astype("i8") for x in ([w for w, _ in rows], [v for _, v in rows]))
        return cls(words, values, starts)

    def part(self, rows: np.ndarray) -> Lists:
        sizes = np.diff(self.starts)[rows]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(self.starts[rows] - starts[:-1], sizes) + np.arange(starts[-1])
        return Lists(self.words[at], self.values[at], starts)

    def products(self, dense: np.ndarray) -> np.ndarray:
        """Inner products with the rows of ``dense`` (a column a word): a row for each of those, a column for each own."""
        sums = np.zeros((len(dense), len(self.starts) - 1), "i8")
        full = np.flatnonzero(np.diff(self.starts))
        step = max(1, AT_ONCE // len(dense))
        cuts = np.searchsorted(self.starts[full], np.arange(0, len(self.words) + step, step))
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a < b:
                rows = full[a:b]
                own = slice(self.starts[rows[0]], self.starts[rows[-1] + 1])
                sums[:, rows] = np.add.reduceat(
                    dense[:, self.words[own]] * self.values[own], self.starts[rows] - own.start, axis=1)
        return sums


@dataclass
class Items:
    """Items in the order of their rarest word, and the nodes above them: ``levels`` from the root's children down to the
    items themselves, ``parents`` with the node above each entry of all levels but the first."""

    ids: list[int | None]
    levels: list[Lists]
    parents: list[np.ndarray]


def item_tree(ids: list, weighted: list[tuple[np.ndarray, np.ndarray]]) -> Items:
    """``weighted`` holds the words of each item and their weights."""
    lead = [int(w[np.argmax(v)]) if len(w) else -1 for w, v in weighted]
    order = sorted(range(len(ids)), key=lead.__getitem__)
    level = [weighted[i] for i in order]
    levels, parents = [Lists.of(level)], []
    while len(level) > FAN:
        above = []
        for start in range(0, len(level), FAN):
            words, values = map(np.concatenate, zip(*level[start:start + FAN]))
            found, at = np.unique(words, return_inverse=True)
            most = np.zeros(len(found), "i8")
            np.maximum.at(most, at, values)
            above.append((found, most))
        parents.insert(0, np.arange(len(level)) // FAN)
        levels.insert(0, Lists.of(above))
        level = above
    return Items([ids[i] for i in order], levels, parents)


class Search:
    """The best ``k`` documents of each item among those that a task sees, from given k-th scores on."""

    def __init__(self, tree: Items, words: int, k: int, weakest: np.ndarray, seeds: bool) -> None:
        self.tree, self.words, self.k, self.seeds = tree, words, k, seeds
        #: A score below this has no place; 1 where fewer than k are known, since only scores above 0 count.
        self.weakest = np.maximum(weakest, 1)
        #: Item, score, id, whether the id is null.
        self.best = [np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0, "i8"), np.empty(0, bool)]
        self.new: list[tuple] = []

    def batch(self, ids: np.ndarray, null: np.ndarray, vectors: Lists) -> None:
        """Batch, nodes and leaves of at most ``BATCH`` documents in turn."""
        used, local = np.unique(vectors.words, return_inverse=True)
        # Words that no document of the batch has share a last column, which stays zero.
        place = np.full(self.words, len(used))
        place[used] = np.arange(len(used))
        levels = [Lists(place[x.words], x.values, x.starts) for x in self.tree.levels]
        owner = np.repeat(np.arange(len(ids)), np.diff(vectors.starts))
        nodes = np.zeros((-(-len(ids) // NODE), len(used) + 1), "i8")
        np.maximum.at(nodes, (owner // NODE, local), vectors.values)
        alive = self.alive(levels, nodes.max(axis=0, keepdims=True))
        if not len(alive):
            return
        bounds = levels[-1].part(alive).products(nodes)
        chosen = np.arange(len(bounds))[:, None] == bounds.argmax(axis=0) if self.seeds else np.ones(bounds.shape, bool)
        # Nodes that promise most come first, so that k-th scores rise early.
        for node in np.argsort(-bounds.max(axis=1), kind="stable"):
            items = alive[chosen[node] & (bounds[node] >= self.weakest[alive])]
            for start in range(node * NODE, min((node + 1) * NODE, len(ids)), LEAF) if len(items) else ():
                end = min(start + LEAF, len(ids))
                own = slice(vectors.starts[start], vectors.starts[end])
                leaf = np.zeros((end - start, len(used) + 1), "i8")
                leaf[owner[own] - start, local[own]] = vectors.values[own]
                self.leaf(ids[start:end], null[start:end], leaf, levels[-1], items)

    def alive(self, levels: list[Lists], dense: np.ndarray) -> np.ndarray:
        """Items that the batch may serve: from the root down, nodes whose bound reaches their weakest k-th score."""
        floors = [self.weakest]
        for parents in reversed(self.tree.parents):
            above = np.full(parents[-1] + 1, np.iinfo("i8").max)
            np.minimum.at(above, parents, floors[0])
            floors.insert(0, above)
        nodes = np.arange(len(floors[0]))
        for depth, level in enumerate(levels):
            if depth:
                wanted = np.zeros(len(floors[depth - 1]), bool)
                wanted[nodes] = True
                nodes = np.flatnonzero(wanted[self.tree.parents[depth - 1]])
            nodes = nodes[level.part(nodes).products(dense)[0] >= floors[depth][nodes]]
        return nodes

    def leaf(self, ids: np.ndarray, null: np.ndarray, leaf: np.ndarray, words: Lists, items: np.ndarray) -> None:
        near = items[words.part(items).products(leaf.max(axis=0, keepdims=True))[0] >= self.weakest[items]]
        if not len(near):
            return
        scores = words.part(near).products(leaf)
        doc, item = np.nonzero(scores >= self.weakest[near])
        if len(doc):
            self.new.append((near[item], scores[doc, item], ids[doc], null[doc]))
            if sum(len(x[0]) for x in self.new) > max(4_096, len(self.best[0]) // 2):
                self.settle()

    def settle(self) -> None:
        """Keep the k best of each item: higher score first, then smaller id, null last."""
        self.best, self.new = [np.concatenate(x) for x in zip(self.best, *self.new)], []
        item, score, ids, null = self.best
        order = np.lexsort((ids, null, -score, item))
        own = item[order]
        starts = np.flatnonzero(np.diff(own, prepend=-1))
        rank = np.arange(len(own)) - np.repeat(starts, np.diff(starts, append=len(own)))
        self.best = [x[order[rank < self.k]] for x in self.best]
        last = order[rank == self.k - 1]
        self.weakest[item[last]] = np.maximum(self.weakest[item[last]], score[last])


def pairs(batch: pa.RecordBatch, words: str, values: str) -> Lists:
    """Two array columns of a batch."""
    starts = np.asarray(batch.column(words).offsets).astype("i8")
    return Lists(*(np.asarray(batch.column(x).flatten()).astype("i8") for x in (words, values)), starts - starts[0])


def placed(rows: DataFrame, weights: np.ndarray, documents: int, length: int) -> DataFrame:
    """Documents that hold a word of the items, with the impacts of these words, next to those of the same rarest word
    and a like length."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)  # at most ITEM_WORDS numbers

    def run(batches):
        weights = shared.value
        for batch in filter(len, batches):
            own = pairs(batch, "words", "times")
            n = batch.column("n").to_pylist()
            # Exact whatever the lengths are.
            means = np.array([50 + 50 * x * documents // length for x in n], "i8")
            times = own.values
            impacts = 10**9 * times // (1000 * times + 20 * np.repeat(means, np.diff(own.starts)))
            rarest = np.maximum.reduceat(weights[own.words] << 32 | own.words, own.starts[:-1]) & (2**32 - 1)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n": batch.column("n"), "lead": rarest, "words": batch.column("words"),
                "impacts": pa.ListArray.from_arrays(pa.array(own.starts, pa.int32()), pa.array(impacts, pa.int32()))})

    found = rows.filter(F.size("words") > 0).mapInArrow(typed(run, _PLACED), _PLACED)
    found = found.withColumn("tie", F.rand(1))
    return staged(found.repartitionByRange("lead", "n", "tie").sortWithinPartitions("lead", "n", "tie").drop("tie"))


def searched(rows: DataFrame, tree: Items, words: int, k: int, weakest: np.ndarray, seeds: bool) -> DataFrame:
    """item, item_id, doc_id, score and rank: the best k of all tasks."""
    shared = rows.sparkSession.sparkContext.broadcast((tree, weakest))

    def run(batches):
        tree, weakest = shared.value
        search = Search(tree, words, k, weakest, seeds)
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                ids = batch.column("doc_id")
                null = np.asarray(ids.is_null())
                search.batch(np.asarray(ids.fill_null(0)), null, pairs(batch, "words", "impacts"))
        search.settle()
        item, score, ids, null = search.best
        yield pa.RecordBatch.from_pydict({
            "item": item, "item_id": pa.array([tree.ids[i] for i in item], pa.int64()),
            "doc_id": pa.array(ids, pa.int64(), mask=null), "score": score})

    found = rows.select("doc_id", "words", "impacts").mapInArrow(typed(run, _FOUND), _FOUND)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def search_block(items: list, documents: DataFrame, k: int, key: str, text: str) -> DataFrame:
    """item_id, rank, doc_id, score for items of a bounded number of words."""
    vocabulary = sorted({word for row in items for word in row["words"]})
    place = {word: i for i, word in enumerate(vocabulary)}
    rows = staged(vectors(documents, key, text, vocabulary))
    whole = rows.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    number, length = whole[0], max(whole[1] or 0, 1)
    holding = rows.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    held = dict(map(tuple, holding.collect()))  # one row a word
    weights = np.array([math.floor(1000 * math.log((2 * number + 2) / (2 * held.get(i, 0) + 1))) for i in range(len(vocabulary))], "i8")
    own = [np.array([place[x] for x in row["words"]], "i8") for row in items]
    tree = item_tree([row["item_id"] for row in items], [(x, weights[x]) for x in own])
    table = placed(rows, weights, number, length)
    weakest = np.zeros(len(items), "i8")
    for row in searched(table, tree, len(vocabulary), k, weakest, True).filter(F.col("rank") == k).collect():  # one an item
        weakest[row["item"]] = row["score"]
    return staged(searched(table, tree, len(vocabulary), k, weakest, False).select("item_id", "rank", "doc_id", "score"))


def search(documents: DataFrame, items: DataFrame, k: int = 50, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of each item among those with a score above 0.

    A score sums weight * impact over the item's distinct words, all in whole numbers: weight
    floor(1000 * ln((2N + 2) / (2 df + 1))), impact 10^9 tf div (1000 tf + 20 m), m = 50 + 50 n N div L. Equal scores go
    by smaller id, a null id last. A text that is null or has no word matches nothing and is not one of the N documents.
    Rows that repeat an id are documents of their own; rows that repeat an item's id are one item. Items without words
    and empty tables give no rows. Other columns are not read. Items are served in blocks of ``ITEM_WORDS`` words, each
    with a pass over all documents.
    """
    rows = staged(item_words(items, item_key, item_text))
    total = rows.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = -(-total // ITEM_WORDS) or 1
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = [search_block(rows.filter((block == i) & (F.size("words") > 0)).collect(), documents, k, key, text) for i in range(blocks)]
    out = found[0]
    for other in found[1:]:
        out = out.union(other)
    return out
