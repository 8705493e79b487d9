"""Token counts, token files and piece round trips against the libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gridloom.llm import pieces, token_counts, token_files
from gridloom.llm.staging import shared_folder
from gridloom.llm.word_tokens import runs

WORDS, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "\n", "a", " a  b ", "It's FINE, isn't it?", "x<|endoftext|>y <|startoftext|>", "½²³ ª\x1cb\x85c",
       "é É İ Σσς ſ", "中文 한국 😀👩‍👧", "a▁b ▁▁", "\x00\t\x0b", "<s></s><unk><0x41>", "word " * 3000, "y" * 20_000, " " * 50]
PARTS = [" ", "  ", "\n", "the", "ing", "ñ", "😀", "\x00", "①", "▁", ".", ",", "'s", "th", "er", "中", "0", "<|endoftext|>",
         "\x1c", "ª", "É", "Σ", "́", "==", "\t", *"abcdefghXYZ"]


@pytest.fixture(scope="module")
def texts():
    dice = random.Random(3)
    return ODD + ["".join(dice.choices(PARTS, k=dice.randrange(14))) for _ in range(400)]


@pytest.fixture(scope="module")
def table(spark, texts):
    """Rows in disorder, one of them twice, with columns whose names clash with those of results."""
    rows = [(i * 7 % 1009, x, i, "x") for i, x in enumerate(texts)] + [(None, "no id", 0, "x"), (0, None, 0, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, ids string").repartition(3)


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def rows_of(table):
    return [(r.doc_id, r.text or "") for r in table.select("doc_id", "text").collect()]


def test_counts(table, words, library):
    for path, count in ((WORDS, lambda x: len(words.encode(x, add_special_tokens=False).ids)), (PIECES, lambda x: len(library.encode(x)))):
        got = sorted(map(tuple, token_counts.token_counts(table, path, limit=100).collect()), key=repr)
        want = [(k, len(x.encode()), count(x), count(x) > 100) for k, x in rows_of(table)]
        assert got == sorted(want, key=repr)


def test_whole_tokens_encode_alone(words):
    proven = token_counts.whole_tokens(WORDS)
    assert len(proven) > 30_000
    assert all(len(words.encode(x, add_special_tokens=False).ids) == 1 for x in random.Random(1).sample(sorted(proven), 500))


def test_files(spark, table, words):
    folder = shared_folder(spark)
    total = token_files.write_token_files(table, folder, WORDS, end_id=2, parts=5)
    got = token_files.read_token_files(spark, folder, WORDS).collect()
    coded = [(k, words.encode(x, add_special_tokens=False).ids + [2]) for k, x in rows_of(table)]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got if r.doc_id is not None) == sorted(
        (k, len(i), crc(i)) for k, i in coded if k is not None)
    order = sorted(got, key=lambda r: r.start)
    keys = [-1 if r.doc_id is None else r.doc_id for r in order]
    assert keys == sorted(keys)
    assert [r.start for r in order] == [sum(r.n_tokens for r in order[:i]) for i in range(len(order))]
    assert total == sum(len(i) for _, i in coded)


def test_files_are_flat(spark, words):
    folder = shared_folder(spark)
    df = spark.createDataFrame([(2, "two words"), (1, "One")], "doc_id long, text string")
    token_files.write_token_files(df, folder, WORDS, end_id=2, parts=1)
    docs, ends, ids = token_files.read_part(token_files.mounted(folder), 0, 2)
    one, two = (words.encode(x, add_special_tokens=False).ids + [2] for x in ("One", "two words"))
    assert (docs.tolist(), ends.tolist(), ids.tolist()) == ([1, 2], [len(one), len(one) + len(two)], one + two)
    assert isinstance(ids, np.memmap)


def test_pieces(table, library):
    got = pieces.digests(pieces.piece_round_trip(table, PIECES)).collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = []
    for k, x in rows_of(table):
        ids = library.encode(x)
        want.append((k, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_tables_agree_with_plain_merging(texts):
    model = pieces.pieces(PIECES)
    for text in texts:
        for word in (text or "").split():
            if not word.startswith("▁▁") and len(word) < 100:
                assert model.table(word) == model.merged(word)


def test_decoding_any_ids(spark, library):
    dice = random.Random(5)
    lists = [[dice.randrange(32_000) if dice.random() < 0.5 else dice.randrange(262) for _ in range(dice.randrange(9))] for _ in range(500)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)] + [(-1, None)], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in pieces.decode_pieces(df, PIECES).collect()}
    assert got.pop(-1) == ""
    assert got == {i: library.decode(x) for i, x in enumerate(lists)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    folder = shared_folder(spark)
    assert token_files.write_token_files(empty, folder, WORDS, end_id=2) == 0
    for df in (token_files.read_token_files(spark, folder, WORDS), token_counts.token_counts(empty, WORDS), pieces.piece_round_trip(empty, PIECES)):
        assert df.count() == 0


def test_runs():
    assert runs(" a\x1cb c d\n") == ["a\x1cb", "c", "d"]


def test_a_repeated_task_leaves_whole_parts(tmp_path):
    """Two attempts of one task: the first that ends names the part, the other's files go."""
    for name, body in (("one", b"first"), ("two", b"other")):
        (tmp_path / name).mkdir()
        for kind in ("ids", "offsets", "docs"):
            (tmp_path / name / kind).write_bytes(body)
        token_files.publish(str(tmp_path / name), str(tmp_path / "000000"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["000000"]
    assert {p.read_bytes() for p in (tmp_path / "000000").iterdir()} == {b"first"}
    with pytest.raises(OSError):
        token_files.publish(str(tmp_path / "none"), str(tmp_path / "x" / "y"))


def test_documents_that_share_a_key_are_in_a_complete_order(spark):
    """However rows are dealt, the files are the same."""
    rows = [(1, f"text {i % 7} of one key") for i in range(40)] + [(None, "b"), (None, "a"), (2, None)]
    made = []
    for parts in (1, 9):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        folder = shared_folder(spark)
        token_files.write_token_files(df, folder, WORDS, end_id=2, parts=1)
        made.append([x.tobytes() for x in token_files.read_part(token_files.mounted(folder), 0, 2)])
    assert made[0] == made[1]


def test_recent_keeps_what_is_in_use():
    from gridloom.llm.batches import Recent

    calls = []

    def make(keys):
        calls.extend(keys)
        return [k.upper() for k in keys]

    memory = Recent(make, 4, "test", longest=5)
    assert memory.of({"a", "b"}) == {"a": "A", "b": "B"}
    assert memory.of({"c", "longer"})["longer"] == "LONGER"
    assert "longer" not in memory.of({"a", "b"})
    for x in "defghij":
        assert memory.of({"a", x})["a"] == "A" and len(memory.now) <= 5
    assert calls.count("a") == 1
