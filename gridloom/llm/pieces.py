"""Encoding and decoding with a merge-type piece vocabulary of sentencepiece.

A text is encoded by a table over its prefixes: for every prefix the last token of its encoding, which is unique. A
vocabulary automaton gives the tokens that end at a position; of those exactly one fits, namely the one that encodes
alone as itself and that forms a compatible pair with the last token of the prefix before it (a pair is compatible if
the two strings together encode as just these two tokens). Ids are read off the table backwards.

The table is kept per word, as no token crosses the places where words are cut: none holds a word mark after another
character, and none holds two characters that never stand side by side in the vocabulary. Only runs of two or more
word marks, whose tokens share one score, are merged directly.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from gridloom.llm.batches import Memo, holding, slices, typed

MARK = "▁"
#: Remembered runs, words and pairs of a task.
RUNS, WORDS, PAIRS = 500_000, 500_000, 500_000
#: Longest text merged by plain scans; the score of a pair that is no piece.
SHORT, NONE = 40, float("-inf")


class Pieces:
    """Tables of a vocabulary; only the list of pieces, scores and kinds is taken from the library."""

    def __init__(self, path: str) -> None:
        library = SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        self.pieces = [library.id_to_piece(i) for i in range(size)]
        skipped = [library.is_byte(i) or library.is_control(i) or library.is_unknown(i) or library.is_unused(i)
                   for i in range(size)]
        self.ids = {p: i for i, p in enumerate(self.pieces) if not skipped[i]}
        self.scores = {p: library.get_score(i) for p, i in self.ids.items()}
        self.bytes = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.controls = {i for i in range(size) if library.is_control(i)}
        if any(re.search(f"[^{MARK}]{MARK}|\n", p) for p in self.ids) or not all(map(library.is_byte, self.bytes)):
            raise ValueError(f"{path} is not a vocabulary of this kind")
        self.beside = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if self.merged(p) == [i]:
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        self.compatible = Memo(self._compatible, PAIRS, "pieces")
        self.words = Memo(self._word, WORDS, "pieces")
        self.runs = Memo(self._run, RUNS, "pieces")
        self.texts = self._texts()

    def merged(self, text: str) -> list[int]:
        """Ids by merging the best pair again and again; the definition that all shortcuts must agree with."""
        if len(text) <= SHORT:
            return self._merged_short(list(text))
        symbols, scores = list(text), self.scores
        left, right = list(range(-1, len(text) - 1)), list(range(1, len(text) + 1))
        right[-1:] = [-1] if text else []

        def offer(a, b):
            if a >= 0 and b >= 0 and (score := scores.get(symbols[a] + symbols[b])) is not None:
                heapq.heappush(queue, (-score, a, b, symbols[a], symbols[b]))

        queue: list = []
        for i in range(len(text) - 1):
            offer(i, i + 1)
        while queue:
            _, a, b, was_a, was_b = heapq.heappop(queue)
            if symbols[a] != was_a or symbols[b] != was_b or right[a] != b:
                continue
            symbols[a], symbols[b] = was_a + was_b, ""
            right[a] = right[b]
            if right[b] >= 0:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        return [i for s in symbols if s for i in self.own(s)]

    def _merged_short(self, symbols: list[str]) -> list[int]:
        score = self.scores.get
        offers = [score(a + b, NONE) for a, b in zip(symbols, symbols[1:])]
        while offers and (best := max(offers)) > NONE:
            i = offers.index(best)
            symbols[i:i + 2] = [symbols[i] + symbols[i + 1]]
            del offers[i]
            if i:
                offers[i - 1] = score(symbols[i - 1] + symbols[i], NONE)
            if i < len(offers):
                offers[i] = score(symbols[i] + symbols[i + 1], NONE)
        return [i for s in symbols for i in self.own(s)]

    def own(self, symbol: str) -> list[int]:
        """A symbol's id, or the ids of its bytes."""
        return [self.ids[symbol]] if symbol in self.ids else [self.bytes[b] for b in symbol.encode("utf-8", "replace")]

    def _compatible(self, pair: tuple[int, int]) -> bool:
        return self.merged(self.pieces[pair[0]] + self.pieces[pair[1]]) == [*pair]

    def table(self, word: str) -> list[int]:
        """Ids of a word through the last tokens of its prefixes."""
        last: list = [None] * (len(word) + 1)
        compatible = self.compatible
        for end, token in self.automaton.iter(word):
            if last[end + 1] is None:
                before = last[end + 1 - token[1]]
                if before is None or compatible[before[0], token[0]]:
                    last[end + 1] = token
        found, at = [], len(word)
        while at:
            if (token := last[at]) is None:
                found.extend(reversed(self.own(word[at - 1])))
                at -= 1
            else:
                found.append(token[0])
                at -= token[1]
        return found[::-1]

    def _word(self, word: str) -> bytes:
        return np.array(self.merged(word) if word.startswith(MARK + MARK) else self.table(word), "<i4").tobytes()

    def _run(self, run: str) -> bytes:
        if run.startswith(MARK + MARK):
            return self.words[run]
        cuts = [0, *(i for i in range(1, len(run)) if run[i - 1:i + 1] not in self.beside), len(run)]
        return b"".join(self.words[run[a:b]] for a, b in zip(cuts, cuts[1:]))

    def encode(self, text: str) -> bytes:
        """Ids of a text, 32 bits each."""
        if not text:
            return b""
        marked = MARK + text.replace(" ", MARK)
        return b"".join(map(self.runs.__getitem__, RUN.findall(marked)))

    def _texts(self) -> list[str]:
        """What each id decodes to; bytes above 127 as lone surrogates until their neighbours are known."""
        shown = [p.replace(MARK, " ") for p in self.pieces]
        for i in self.controls:
            shown[i] = GAP
        for b, i in enumerate(self.bytes):
            shown[i] = chr(b) if b < 128 else chr(0xDC00 + b)
        if "<unk>" in self.pieces:
            shown[self.pieces.index("<unk>")] = " ⁇ "
        return shown

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the mark that encoding puts before a text goes, bytes that form no character become U+FFFD."""
        text = "".join(map(self.texts.__getitem__, ids))
        first = next((i for i in ids if i not in self.controls), None)
        if first is not None and self.pieces[first].startswith(MARK):
            text = text.replace(" ", "", 1)
        if HIGH.search(text):
            text = HIGH.sub(lambda m: characters(m[0]), text)
        return text.replace(GAP, "")


#: Word marks with what follows them, marks alone, or a line break, which is in no piece.
RUN = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
#: Stands for a control id, which parts the bytes on its sides.
GAP = "\udbff"
HIGH = re.compile("[\udc80-\udcff]+")


def characters(run: str) -> str:
    """Characters of a run of bytes, U+FFFD for each byte that belongs to none."""
    raw, found, at = bytes(ord(c) - 0xDC00 for c in run), [], 0
    while at < len(raw):
        for n in (4, 3, 2):
            try:
                found.append(raw[at:at + n].decode())
            except UnicodeDecodeError:
                continue
            if len(found[-1]) == 1:
                at += n
                break
            found.pop()
        else:
            found.append("�")
            at += 1
    return "".join(found)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def count_pieces(path: str, texts: list[str]) -> list[int]:
    encode = pieces(path).encode
    return [len(encode(x)) // 4 for x in texts]


def id_lists(coded: list[bytes]) -> pa.Array:
    """Rows of packed ids as an Arrow list column, without a Python number for each id."""
    offsets = np.zeros(len(coded) + 1, "i4")
    np.cumsum([len(x) // 4 for x in coded], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), "<i4")))


def piece_round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids (array of int) and decoded (the text of these ids) of every row.

    A null text is empty: no ids, decoded to an empty text. Repeated rows give repeated rows; other columns are not
    read; an empty table gives no rows.
    """
    schema = "doc_id long, ids array<int>, decoded string"

    def run(batches):
        holding("pieces")
        model = pieces(path)
        for part in slices(batches):
            coded = [model.encode(x or "") for x in part["t"]]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part["k"], "ids": id_lists(coded),
                "decoded": [model.decode(np.frombuffer(x, "<i4").tolist()) for x in coded],
            })

    columns = df.select(df[key].cast("long").alias("k"), df[text].cast("string").alias("t"))
    return columns.mapInArrow(typed(run, schema), schema)


def decode_pieces(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id and decoded of rows with an array of ids; null ids decode to an empty text."""
    schema = "doc_id long, decoded string"

    def run(batches):
        holding("pieces")
        model = pieces(path)
        for part in slices(batches):
            yield pa.RecordBatch.from_pydict({"doc_id": part["k"], "decoded": [model.decode(x or []) for x in part["i"]]})

    columns = df.select(df[key].cast("long").alias("k"), F.col(ids).cast("array<int>").alias("i"))
    return columns.mapInArrow(typed(run, schema), schema)


def digests(df: DataFrame) -> DataFrame:
    """Number and digests of ids, digest of the decoded text."""
    return df.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
