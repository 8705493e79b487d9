"""Token counts by a whole-token shortcut.

Which vocabulary strings encode alone as exactly one token is proven once, before the job, by encoding each of them.
A pre-token among those counts one; only the rest is merged, and a merged count is remembered.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, functions as F

from gridloom.llm.batches import Memo, holding, map_texts
from gridloom.llm.word_tokens import added_strings, library_ids, pre_tokens, runs, tokenizer

#: Remembered runs and pre-tokens of a task.
RUNS, WORDS = 600_000, 600_000


def byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes stand for themselves, others follow 255."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def whole_tokens(path: str) -> frozenset[str]:
    """Texts of the vocabulary strings that encode alone as their own single token; bounded by the vocabulary."""
    letters, tk, proven = byte_letters(), tokenizer(path), set()
    for string, number in tk.get_vocab(with_added_tokens=False).items():
        body = string.removesuffix("</w>")
        try:
            text = bytes(letters[c] for c in body).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if text and pre_tokens(text, added_strings(path)) == [text] and library_ids(path, text) == [number]:
            proven.add(text)
    return frozenset(proven)


@lru_cache(maxsize=4)
def counter(path: str, whole: frozenset[str]) -> Memo:
    """Number of tokens of a run."""
    added = added_strings(path)

    def merged(word: str) -> int:
        return len(library_ids(path, word))

    words = Memo(merged, WORDS, "counts")

    def count(run: str) -> int:
        parts = pre_tokens(run, added)
        if parts is None:
            return len(library_ids(path, run))
        return sum(1 if x in whole else words[x] for x in parts)

    return Memo(count, RUNS, "counts")


def token_counts(df: DataFrame, path: str, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every row.

    ``path`` is a tokenizer of the tokenizers library (.json, BPE with word ends, as word_bpe_49k) or of sentencepiece
    (.model). A null text is empty: 0 bytes, 0 tokens. Repeated rows give repeated rows; other columns are not read;
    an empty table gives no rows.
    """
    if path.endswith(".model"):
        from gridloom.llm.pieces import count_pieces

        def make():
            holding("pieces")
            return lambda keys, texts: row(keys, texts, count_pieces(path, texts))
    else:
        whole = df.sparkSession.sparkContext.broadcast(whole_tokens(path))

        def make():
            holding("counts")
            count = counter(path, whole.value).__getitem__
            return lambda keys, texts: row(keys, texts, [sum(map(count, runs(x))) for x in texts])

    def row(keys, texts, tokens):
        return {"doc_id": keys, "n_bytes": [len(x.encode()) for x in texts], "n_tokens": tokens}

    counted = map_texts(df, make, "doc_id long, n_bytes long, n_tokens long", key, text)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
