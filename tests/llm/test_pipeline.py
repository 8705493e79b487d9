"""The stages one by one against brute force on a small folder of tables."""

import hashlib
import random

import pytest
import sentencepiece

import corpus_pipeline as pipeline
from gridloom.llm import language, secret_scan, tiling

SYLLABLES = {"aa": "ka to mi ru sen lo".split(), "bb": "bra ung sch tel eim off".split()}


def words(dice, lang, n):
    return ["".join(dice.choices(SYLLABLES[lang], k=dice.randrange(1, 4))) for _ in range(n)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    dice, rows = random.Random(4), []
    items = [(i, " ".join(words(dice, "aa", 25))) for i in range(5)]
    for i in range(120):
        lang = dice.choice(sorted(SYLLABLES))
        rows.append((i, " ".join(words(dice, lang, dice.randrange(30, 90))), lang))
    for i in range(20):
        base = rows[i][1].split()
        base[3] = "changed"
        rows.append((200 + i, " ".join(base), rows[i][2]))
    rows += [(300, rows[5][1], "aa"), (301, None, "aa"), (302, "12 34", "bb"), (303, items[2][1], "aa"), (300, rows[5][1], "aa"),
             (304, " ".join(words(dice, "bb", 20)) + " " + " ".join(items[1][1].split()[12:] + items[1][1].split()[:12]), "bb"),
             (305, " ".join(words(dice, "aa", 20)) + " password=abcdef0123456789", "aa"), (306, "ψχω ξζθ " * 60, None)]
    at = tmp_path_factory.mktemp("tables")
    full = [(i, t, lang, "src", len(t or "")) for i, t, lang in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at)


def shingles(text):
    w = text.lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, results = docs.columns, []
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, folder).persist()
        results.append(docs)
    first = {r.doc_id: r.text for r in results[0].collect()}
    assert set(first) == {r.doc_id for r in spark.read.parquet(f"{folder}/documents.parquet").collect()} - {301, 302, 306}

    sets = {i: shingles(t) for i, t in first.items()}
    root = {i: i for i in sets}
    for a in sorted(sets):
        for b in sorted(sets):
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = {i: new if r == old else r for i, r in root.items()}
    kept = {i for i, r in root.items() if i == r}
    assert sorted(r.doc_id for r in results[1].collect()) == sorted(kept)
    assert len(kept) < len(first) - 15

    benchmark = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    block = tiling.Block(benchmark, tiling.SEED)
    clean = {i for i in kept if not tiling.overlaps(first[i], block, tiling.COVERAGE)}
    assert {303, 304} <= kept - clean and len(clean) > 90
    assert {r.doc_id for r in results[2].collect()} == clean

    third = {r.doc_id: r for r in results[3].collect()}
    assert set(third) == clean
    assert third[305].text.endswith(" " + secret_scan.REDACTED) and third[305].n_chars == len(third[305].text)
    assert all(third[i].text == first[i] for i in clean - {305})
    assert all(r.columns == columns for r in results[:4])

    library = sentencepiece.SentencePieceProcessor(model_file=pipeline.PIECES)
    for r in results[4].collect():
        ids = library.encode(third[r.doc_id].text)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(third[r.doc_id].text.encode()).hexdigest()


def test_without_documents(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert language.learn(none) is None
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def one_of_each(spark, rows):
    docs = spark.createDataFrame([(i, t, "aa", "src", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.one_of_each(spark, docs.repartition(4), None)
    assert kept.columns == docs.columns
    return sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)


def test_rows_without_id_beside_repeats(spark):
    a, b, c, d = (" ".join(words(random.Random(i), "aa", 30)) for i in range(4))
    rows = [(None, a), (None, b), (None, b), (7, c), (7, c), (8, c), (9, d), (10, a)]
    assert one_of_each(spark, rows) == sorted([(None, a), (None, b), (None, b), (7, c), (9, d), (10, a)], key=repr)


def test_one_id_with_two_texts(spark):
    a, b, c, d = (" ".join(words(random.Random(i), "aa", 30)) for i in range(10, 14))
    assert one_of_each(spark, [(5, a), (5, b), (3, b), (4, c)]) == sorted([(5, a), (3, b), (4, c)])
    assert one_of_each(spark, [(5, a), (5, b), (7, a), (8, b)]) == sorted([(7, a), (8, b)])
    assert one_of_each(spark, [(5, a), (5, b), (7, a), (6, d), (6, "")]) == sorted([(5, b), (7, a), (6, d)])
