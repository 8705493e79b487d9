"""Language identification with character models of interpolated Kneser-Ney smoothing, one per language.

Texts are lower-cased runs of letters, each framed by a start and an end mark. Counts of character sequences come from
all labelled training rows; lower orders count the distinct characters before a sequence, except at the start of a
run. Counts of all orders, totals and discounts are aggregates of Spark over all sequences. The models of all languages
share sorted arrays of 64-bit hashes, one for the sequences and one for the contexts of each order, with a column per
language. Models that exceed a bound are cut into blocks by ranges of the context read backwards, so a character needs
one block only; each block is broadcast, and a task opens one at a time. The lowest cross-entropy per character wins. A
text whose best cross-entropy lies beyond what training texts of its length show is rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from gridloom.llm.batches import ROWS, holding, slices, typed
from gridloom.llm.staging import staged

ORDER = 4
#: Numbers (sequences and contexts times languages) that a block of the models holds, about; nothing is left out.
BLOCK = 1_000_000
#: Characters of text and new words for which a task opens the blocks of models in turn, and words scored at once.
AHEAD, AHEAD_WORDS, AT_ONCE = 8_000_000, 100_000, 10_000
#: Deviations and bits per character beyond which rejection sets in.
DEVIATIONS, MARGIN = 8.0, 1.0
#: Characters that count as independent evidence for the confidence, and words remembered by a task.
EVIDENCE, REMEMBERED, WORDS_HELD = 20, 300_000, 200_000
START, STOP = "\x02", "\x03"
LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: What scoring adds to a row.
_SCORED = {"_id_lang": "string", "_id_score": "double", "_id_entropy": "double", "_id_chars": "double", "_id_own": "double"}
_LABEL, _TEACHES = "_id_label", "_id_teaches"
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bits of a character in the key of a context, and the highest key.
_BITS = 21
_LAST = 2 ** ((ORDER - 1) * _BITS) - 1


def letter_runs(text: str) -> list[str]:
    """Runs of letters; digits of any kind and signs part them."""
    found = LETTERS.findall(text)
    if not all(map(str.isalpha, found)):
        # Fractions, raised and circled numbers are word characters, but no letters.
        found = "".join(c if c.isalpha() else " " for c in " ".join(found)).split()
    return found


def is_held_out(key: str = "doc_id") -> Column:
    """Rows that models never learn from: a quarter, by the checksum of the id."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def grams_of(word: str) -> list[str]:
    """Sequences of the highest order, and the shorter ones at the start."""
    framed = START + word + STOP
    return [framed[max(0, i - ORDER):i] for i in range(2, len(framed) + 1)]


def gram_counts(rows: DataFrame) -> DataFrame:
    """lang, gram, n over all rows (lang, text). A task counts words, then their sequences, and sends what it holds
    whenever it holds many words."""
    schema = "lang string, gram string, n long"

    def run(batches):
        words: dict[str, Counter] = {}

        def sums():
            for lang, counted in words.items():
                grams: Counter = Counter()
                for chunk, n in counted.items():
                    for word in letter_runs(chunk):
                        for gram in grams_of(word):
                            grams[gram] += n
                names = [*grams]
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(names), "gram": names, "n": [*grams.values()]})
            words.clear()

        for part in slices(batches):
            for lang, text in zip(part["lang"], part["text"]):
                words.setdefault(lang, Counter()).update(text.lower().split())
            if sum(map(len, words.values())) > WORDS_HELD:
                yield from sums()
        yield from sums()

    return rows.mapInArrow(typed(run, schema), schema).groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` characters that end at each position; the first positions wrap and must not be used."""
    found = np.full(len(codes), np.uint64(length))
    for back in range(length - 1, -1, -1):
        found = (found ^ np.roll(codes, back)) * _BASE
        found ^= found >> np.uint64(29)
    return found


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")


@dataclass
class Table:
    """Sorted hashes with a row of numbers each."""

    keys: np.ndarray
    rows: np.ndarray
    default: float

    def find(self, wanted: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full((len(wanted), self.rows.shape[1]), self.default)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where((self.keys[at] == wanted)[:, None], self.rows[at], self.default)


def table_of(grams: list[str], columns: np.ndarray, values: np.ndarray, languages: int, default: float) -> Table:
    length = len(grams[0]) if grams else 1
    codes = np.concatenate([codes_of("".join(grams)), np.empty(0, "u8")])
    keys = hashes(codes, length)[length - 1::length] if grams else np.empty(0, "u8")
    unique, at = np.unique(keys, return_inverse=True)
    rows = np.full((len(unique), languages), default)
    rows[at, columns] = values
    return Table(unique, rows, default)


@dataclass
class Models:
    languages: list[str]
    added: list[Table]
    passed: list[Table]
    letters: int
    #: Mean and scaled deviation of the cross-entropy of training texts, per language.
    usual: np.ndarray | None = None
    #: The keys of contexts that these tables cover.
    first: int = 0
    last: int = _LAST
    #: Broadcast blocks that stand for the tables where these are too large for one.
    parts: list[Broadcast] = field(default_factory=list)

    def blocks(self) -> Iterator[Models]:
        """The tables, a block at a time; a block is dropped before the next one is read."""
        if not self.parts:
            yield self
        for part in self.parts:
            yield part.value if hasattr(part, "_value") else part.load_from_path(part._path)

    def word_bits(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits of each chunk under each language, as far as its contexts belong here, and its number of predicted
        characters."""
        framed = ["".join(START + run + STOP for run in letter_runs(w)) for w in words]
        lengths = np.array([*map(len, framed)], int)
        codes = codes_of("".join(framed))
        starts = codes == 2
        depth = np.arange(len(codes)) - np.maximum.accumulate(np.where(starts, np.arange(len(codes)), 0))
        mine = ~starts
        if (self.first, self.last) != (0, _LAST):
            place = np.zeros(len(codes), "u8")
            for back in range(1, ORDER):
                place = place << np.uint64(_BITS) | np.where(depth >= back, np.roll(codes, back), np.uint64(0))
            mine &= (place >= np.uint64(self.first)) & (place <= np.uint64(self.last))
        chance = np.full((len(codes), len(self.languages)), 1 / self.letters)
        for order in range(1, ORDER + 1):
            known = np.flatnonzero((depth >= order - 1) & mine)
            own = hashes(codes, order)[known]
            context = np.roll(hashes(codes, order - 1), 1)[known] if order > 1 else np.zeros(len(known), "u8")
            chance[known] = self.added[order - 1].find(own) + self.passed[order - 1].find(context) * chance[known]
        bits = np.where(mine[:, None], -np.log2(np.maximum(chance, 1e-12)), 0)
        owner = np.repeat(np.arange(len(words)), lengths)
        summed = np.zeros((len(words), len(self.languages)))
        some = np.flatnonzero(lengths)
        if len(some):
            summed[some] = np.add.reduceat(bits, (np.cumsum(lengths) - lengths)[some])
        return summed, np.bincount(owner, ~starts, len(words)).astype(float)


def fit(counts: list[tuple[str, str, int]]) -> Models:
    """Models from (language, sequence, count) of the highest order and of the starts, for lists that fit memory."""
    languages = sorted({r[0] for r in counts})
    place = {x: i for i, x in enumerate(languages)}
    levels: list[dict] = [{} for _ in range(ORDER + 1)]
    for lang, gram, n in counts:
        levels[len(gram)][place[lang], gram] = n
    for length in range(ORDER, 1, -1):
        shorter = levels[length - 1]
        for lang, gram in levels[length]:
            shorter[lang, gram[1:]] = shorter.get((lang, gram[1:]), 0) + 1
    for length in range(1, ORDER + 1):
        levels[length] = {k: n for k, n in levels[length].items() if k[1] != START}
    added, passed, size = [], [], len(languages)
    for length in range(1, ORDER + 1):
        level = levels[length]
        totals: Counter = Counter()
        kinds: Counter = Counter()
        for (lang, gram), n in level.items():
            totals[lang, gram[:-1]] += n
            kinds[lang, gram[:-1]] += 1
        ones, twos = Counter(k[0] for k, n in level.items() if n == 1), Counter(k[0] for k, n in level.items() if n == 2)
        discount = {i: ones[i] / (ones[i] + 2 * twos[i]) if ones[i] and twos[i] else 0.5 for i in range(size)}
        keys = [*level]
        added.append(table_of(
            [g for _, g in keys], np.array([i for i, _ in keys], int),
            np.array([max(level[k] - discount[k[0]], 0) / totals[k[0], k[1][:-1]] for k in keys]), size, 0.0))
        keys = [*totals]
        share = np.array([discount[k[0]] * kinds[k] / totals[k] for k in keys])
        if length == 1:
            rows = np.ones((1, size))
            rows[0, [i for i, _ in keys]] = share
            passed.append(Table(np.zeros(1, "u8"), rows, 1.0))
        else:
            passed.append(table_of([g for _, g in keys], np.array([i for i, _ in keys], int), share, size, 1.0))
    return Models(languages, added, passed, len({g for _, g in levels[1]}) + 1)


def levels_of(counts: DataFrame) -> DataFrame:
    """lang, gram, n of all orders from the counts of the highest order and of the starts."""
    level = counts.filter(F.length("gram") == ORDER)
    found = level
    for length in range(ORDER - 1, 0, -1):
        level = level.groupBy("lang", F.substring("gram", 2, length).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
        level = level.union(counts.filter(F.length("gram") == length))
        found = found.union(level)
    return found.filter(F.col("gram") != START)


def figures_of(levels: DataFrame) -> DataFrame:
    """What a sequence adds and what a context passes on: adds, size (the order), context, gram, lang, value."""
    size, context = F.length("gram"), F.expr("left(gram, length(gram) - 1)")
    rows = levels.select("lang", "gram", "n", size.alias("size"), context.alias("context"))
    ones, twos = (F.count(F.when(F.col("n") == x, 1)) for x in (1, 2))
    discount = F.when((ones > 0) & (twos > 0), ones / (ones + 2 * twos)).otherwise(0.5)
    discounts = rows.groupBy("lang", "size").agg(discount.alias("discount"))
    contexts = rows.groupBy("lang", "size", "context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    contexts = staged(contexts.join(discounts, ["lang", "size"]))
    added = rows.join(contexts, ["lang", "size", "context"]).select(
        F.lit(True).alias("adds"), "size", "context", "gram", "lang",
        (F.greatest(F.col("n") - F.col("discount"), F.lit(0.0)) / F.col("total")).alias("value"))
    passed = contexts.select(
        F.lit(False), "size", "context", F.col("context").alias("gram"), "lang",
        F.col("discount") * F.col("kinds") / F.col("total"))
    return added.union(passed)


def key_of(context: Column, fill: int) -> Column:
    """A context read backwards as a number; characters that it does not have count as ``fill``."""
    out = F.lit(0).cast("long")
    for back in range(1, ORDER):
        code = F.when(F.length(context) >= back, F.ascii(F.substring(context, -back, 1))).otherwise(fill)
        out = F.shiftleft(out, _BITS).bitwiseOR(code.cast("long"))
    return out


def tables_of(figures: DataFrame, languages: list[str], letters: int, first: int = 0, last: int = _LAST) -> Models:
    """One block of models."""
    found = figures.select("adds", "size", "gram", "lang", "value").toArrow()
    adds, sizes, values = (found[x].to_numpy() for x in ("adds", "size", "value"))
    grams, langs = np.array(found["gram"].to_pylist(), object), found["lang"].to_pylist()
    place = {x: i for i, x in enumerate(languages)}
    columns = np.fromiter((place[x] for x in langs), int, len(langs))
    added, passed = [], []
    for size in range(1, ORDER + 1):
        at = np.flatnonzero(adds & (sizes == size))
        added.append(table_of(list(grams[at]), columns[at], values[at], len(languages), 0.0))
        at = np.flatnonzero(~adds & (sizes == size))
        if size == 1:
            rows = np.ones((1, len(languages)))
            rows[0, columns[at]] = values[at]
            passed.append(Table(np.zeros(1, "u8"), rows, 1.0))
        else:
            passed.append(table_of(list(grams[at]), columns[at], values[at], len(languages), 1.0))
    return Models(languages, added, passed, letters, first=first, last=last)


def models_of(counts: DataFrame) -> Models | None:
    """Models from lang, gram, n: in one piece, or in blocks that no more than one is held of at a time."""
    levels = staged(levels_of(counts))
    # As many rows as there are languages.
    languages = sorted(r.lang for r in levels.select("lang").distinct().collect())
    if not languages:
        return None
    letters = levels.filter(F.length("gram") == 1).select("gram").distinct().count() + 1
    figures = staged(figures_of(levels))
    kinds = figures.groupBy("adds", "size", "context", "gram").agg(F.count(F.lit(1)).alias("n"))
    cells = kinds.count() * len(languages)
    if cells <= BLOCK:
        return tables_of(figures, languages, letters)
    low, high = key_of(F.col("context"), 0), key_of(F.col("context"), 2 ** _BITS - 1)
    pieces = -(-cells // BLOCK)
    cuts = kinds.select(low.alias("low")).agg(F.percentile_approx(
        "low", [i / pieces for i in range(1, pieces)], F.lit(100 * pieces))).first()[0]
    edges = [0, *sorted({*cuts} - {0})]
    block_of = lambda key: F.size(F.filter(F.lit(edges).cast("array<long>"), lambda x: x <= key)) - 1
    # A short context goes to each block that holds longer ones which end with it.
    placed = figures.withColumn("block", F.explode(F.sequence(block_of(low), block_of(high))))
    placed = staged(placed.repartitionByRange("block").sortWithinPartitions("block"))
    parts = []
    for i, (first, end) in enumerate(zip(edges, [*edges[1:], _LAST + 1])):
        block = tables_of(placed.filter(F.col("block") == i), languages, letters, first, end - 1)
        parts.append(counts.sparkSession.sparkContext.broadcast(block))
    return Models(languages, [], [], letters, parts=parts)


class Scorer:
    """Cross-entropies of texts; remembers the bits of chunks between white space."""

    def __init__(self, models: Models) -> None:
        holding("language")
        self.models = models
        self.fresh()

    def fresh(self) -> None:
        self.places: dict[str, int] = _Places()
        self.bits = np.zeros((1024, len(self.models.languages) + 1))

    def sums(self, parts: Iterable, texts: Callable) -> Iterator[tuple]:
        """Each part with the bits under each language and the number of characters of its texts, ``texts(part)``.

        Models in blocks are read for many parts at once.
        """
        held, size = [], 0
        for part in parts:
            if not held and len(self.places) > REMEMBERED:
                self.fresh()
            own = [x or "" for x in texts(part)]
            held.append((part, [np.fromiter(map(self.places.__getitem__, x.lower().split()), int) for x in own]))
            size += sum(map(len, own))
            if not self.models.parts or size > AHEAD or len(self.places.new) > AHEAD_WORDS:
                yield from self.done(held)
                held, size = [], 0
        yield from self.done(held)

    def done(self, held: list[tuple]) -> Iterator[tuple]:
        new, known = self.places.new, len(self.places) - len(self.places.new)
        if new:
            if len(self.places) > len(self.bits):
                self.bits = np.concatenate([self.bits, np.zeros((len(self.places), self.bits.shape[1]))])
            for block in self.models.blocks():
                for start in range(0, len(new), AT_ONCE):
                    bits, chars = block.word_bits(new[start:start + AT_ONCE])
                    rows = self.bits[known + start:known + start + len(bits)]
                    rows[:, :-1] += bits
                    rows[:, -1] = chars
            self.places.new = []
        for part, rows in held:
            yield part, np.array([self.bits[r].sum(axis=0) for r in rows]).reshape(len(rows), self.bits.shape[1])


class _Places(dict):
    """Numbers keys as they come and lists those not worked out yet."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = place = len(self)
        self.new.append(key)
        return place


def shipped(df: DataFrame, models: Models) -> Models | Broadcast:
    """What tasks take along: blocks are broadcast already."""
    return models if models.parts else df.sparkSession.sparkContext.broadcast(models)


def opened(shared: Models | Broadcast) -> Models:
    return shared.value if isinstance(shared, Broadcast) else shared


def entropies(sums: np.ndarray) -> np.ndarray:
    return sums[:, :-1] / np.maximum(sums[:, -1:], 1)


def learn(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Models | None:
    """Models from all rows that are not held out and have a text and a language; None without any."""
    models = models_from(df, key, text, lang)
    if models is None:
        return None
    rows = df.filter(teaches(key, text, lang))
    rows = rows.select(F.col(lang).cast("string").alias(_LABEL), F.col(text).cast("string").alias("text"))
    models.usual = calibrated(scored(rows, models, "text", _LABEL), models)
    return models


def models_from(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Models | None:
    """Models from all rows that are not held out and have a text and a language, not calibrated yet."""
    rows = df.filter(teaches(key, text, lang))
    counts = staged(gram_counts(rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))))
    return models_of(counts)


def teaches(key: str, text: str, lang: str) -> Column:
    return ~is_held_out(key) & F.col(key).isNotNull() & F.col(lang).isNotNull() & F.col(text).isNotNull()


def scored(df: DataFrame, models: Models, text: str, lang: str | None = None) -> DataFrame:
    """The rows of ``df`` with what the models say of them, in columns beginning with ``_id_``: language, score,
    entropy (bits per character of that language), characters, and bits under the row's own ``lang``."""
    shared = shipped(df, models)
    schema = StructType([*df.schema.fields, *StructType.fromDDL(", ".join(f"{n} {k}" for n, k in _SCORED.items())).fields])
    names = [f.name for f in schema]
    text_at, lang_at = df.columns.index(text), df.columns.index(lang) if lang else None

    def run(batches):
        models = opened(shared)
        place = {x: i for i, x in enumerate(models.languages)}
        parts = (batch.slice(start, ROWS) for batch in batches for start in range(0, batch.num_rows, ROWS))
        for part, sums in Scorer(models).sums(parts, lambda x: x.column(text_at).to_pylist()):
            pred, score, entropy = verdicts(models, sums)
            own = np.array([place.get(x, -1) for x in part.column(lang_at).to_pylist()], int) if lang else np.full(len(pred), -1)
            bits = sums[np.arange(len(own)), own]
            added = [pa.array(pred, pa.string()), pa.array(score), pa.array(entropy), pa.array(sums[:, -1].astype(float)),
                     pa.array(bits.astype(float), mask=own < 0)]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], names)

    return df.mapInArrow(run, schema)


def calibrated(rows: DataFrame, models: Models) -> np.ndarray:
    """Mean and scaled deviation of each language from scored rows that teach; the driver sees a row a language."""
    chars, bits = F.col("_id_chars"), F.col("_id_own")
    sums = rows.filter((chars > 0) & bits.isNotNull()).groupBy(_LABEL).agg(
        F.count(F.lit(1)), F.sum(chars), F.sum(bits), F.sum(bits * bits / chars))
    place = {x: i for i, x in enumerate(models.languages)}
    return usual_of({place[r[0]]: tuple(r)[1:] for r in sums.collect()}, len(place))


def is_strange(models: Models) -> Column:
    """Whether a scored row is rejected: no letter, or a cross-entropy beyond what texts of its length show."""
    of = lambda column: F.element_at(F.create_map(*[
        x for i, name in enumerate(models.languages) for x in (F.lit(name), F.lit(float(models.usual[i, column])))]), F.col("_id_lang"))
    chars = F.col("_id_chars")
    beyond = F.col("_id_entropy") - of(0) > MARGIN + DEVIATIONS * of(1) / F.sqrt(F.greatest(chars, F.lit(1.0)))
    return F.when(chars > 0, beyond).otherwise(True)


def usual_of(sums: dict[int, tuple], languages: int) -> np.ndarray:
    """Mean and scaled deviation per language from number of texts, characters, bits and squared bits by characters.

    A deviation counts one text more, which deviates as those of all languages do: few texts alone would seem alike.
    """
    n, chars, bits, squares = np.array([sums.get(i, (0, 0, 0, 0)) for i in range(languages)], float).T
    mean = bits / np.maximum(chars, 1)
    apart = np.maximum(squares - mean * bits, 0)
    return np.column_stack([mean, np.sqrt((apart + apart.sum() / max(n.sum(), 1)) / (n + 1))])


def predict(df: DataFrame, models: Models | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, entropy (bits per character of lang_pred) and rejected of every row.

    A null text or one without a letter is ``und`` with score 0, and so is everything without models; ``und`` is
    rejected. The score is the share of lang_pred among all languages. Repeated rows give repeated rows; an empty table
    gives no rows. Only id and text are read.
    """
    columns = df.select(df[key].cast("long").alias("doc_id"), df[text].cast("string").alias("t"))
    if models is None:
        return columns.select(
            "doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
            F.lit(None).cast("double").alias("entropy"), F.lit(True).alias("rejected"))
    return judged(scored(columns, models, "t"), models)


def judged(rows: DataFrame, models: Models) -> DataFrame:
    return rows.select("doc_id", F.col("_id_lang").alias("lang_pred"), F.col("_id_score").alias("score"),
                       F.col("_id_entropy").alias("entropy"), is_strange(models).alias("rejected"))


def identify(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """What ``predict`` gives with what ``learn`` learns from the same table, each text scored once."""
    models = models_from(df, key, text, lang)
    if models is None:
        return predict(df, None, key, text)
    rows = df.select(df[key].cast("long").alias("doc_id"), df[text].cast("string").alias("text"), df[lang].alias("lang"))
    return judged(calibrated_rows(rows, models, ["doc_id"], "doc_id", "text", "lang"), models)


def calibrated_rows(df: DataFrame, models: Models, keep: list[str], key: str, text: str, lang: str) -> DataFrame:
    """Stored scores of every row with the columns of ``keep``; calibrates the models on the rows that teach."""
    rows = df.withColumns({_LABEL: F.col(lang).cast("string"), _TEACHES: teaches(key, text, lang)})
    found = staged(scored(rows, models, text, _LABEL).select(*keep, _TEACHES, _LABEL, *_SCORED))
    models.usual = calibrated(found.filter(_TEACHES), models)
    return found


def verdicts(models: Models, sums: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, score and entropy of texts."""
    chars, bits = sums[:, -1], entropies(sums)
    best = bits.argmin(axis=1)
    lowest = bits[np.arange(len(best)), best]
    weight = np.minimum(chars, EVIDENCE)[:, None]
    score = 1 / np.exp2((lowest[:, None] - bits) * weight).sum(axis=1)
    known = chars > 0
    pred = [models.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
    return pred, np.where(known, score, 0.0), np.where(known, lowest, np.nan)


def accepted(df: DataFrame, models: Models | None, text: str = "text") -> DataFrame:
    """The rows of ``df`` whose text is not rejected, with all their columns; none without models."""
    if models is None:
        return df.limit(0)
    return scored(df, models, text).filter(~is_strange(models)).select(df.columns)


def acceptable(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``df`` that models learned from ``df`` itself do not reject, each text scored once.

    A table without any labelled text teaches nothing, so no row of it is accepted.
    """
    models = models_from(df, key, text, lang)
    if models is None:
        return df.limit(0)
    rows = calibrated_rows(df, models, df.columns, key, text, lang)
    return rows.filter(~is_strange(models)).select(df.columns)
