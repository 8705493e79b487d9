"""Language identification on held-out rows, and the models against a plain reading of the smoothing rule."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridloom.llm import language

SYLLABLES = {"aa": "ka to mi ru sen lo".split(), "bb": "bra ung sch tel eim off".split(), "cc": "é çon eau oi ier mé".split()}
SCHEMA = "doc_id long, text string, lang string, score string"


def text(dice, lang, n=40):
    return " ".join("".join(dice.choices(SYLLABLES[lang], k=dice.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    dice = random.Random(9)
    out = [(i, text(dice, lang), lang, "x") for i, lang in enumerate(dice.choices(sorted(SYLLABLES), k=600))]
    return out + [(1000, None, "aa", "x"), (1001, "", "bb", "x"), (1002, "12 34 !!", "aa", "x"), (None, "kato", None, "x"),
                  (1003, "KATO " * 5000, None, "x"), (1004, "ψχω ξζθ " * 60, None, "x"), (1003, "schung", None, "x")]


@pytest.fixture(scope="module")
def found(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return df, language.learn(df)


def test_held_out_rows(found):
    df, models = found
    got = language.predict(df, models).join(df.select("doc_id", "lang").dropDuplicates(["doc_id"]), "doc_id")
    held = got.filter(language.is_held_out()).filter("doc_id < 1000").collect()
    assert len(held) > 100
    assert sum(r.lang == r.lang_pred for r in held) >= 0.99 * len(held)
    assert all(0 <= r.score <= 1 and not r.rejected for r in held)


def test_odd_texts(found):
    df, models = found
    got = {}
    for r in language.predict(df, models).filter("doc_id >= 1000 or doc_id is null").collect():
        got.setdefault(r.doc_id, []).append((r.lang_pred, r.rejected))
    for i in (1000, 1001, 1002):
        assert got[i] == [("und", True)]
    assert sorted(got[1003]) == [("aa", False), ("bb", False)] and got[None] == [("aa", False)]
    assert got[1004][0][1]


def test_rejected_rows_go_with_all_columns_kept(found):
    df, models = found
    kept = language.accepted(df, models)
    assert kept.schema == df.schema
    assert kept.count() == df.count() - 4


def test_held_out_rows_teach_nothing(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    other = df.withColumn("text", F.when(language.is_held_out(), F.lit("zzz")).otherwise(F.col("text")))
    first, second = language.learn(df), language.learn(other)
    assert all((a.keys == b.keys).all() and (a.rows == b.rows).all() for a, b in zip(first.added, second.added))


def test_without_rows_or_labels(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert language.learn(empty) is None
    none = spark.createDataFrame([(1, "kato", None, "x")], SCHEMA)
    assert language.predict(none, language.learn(none)).first()[1:3] == ("und", 0.0)
    assert language.predict(empty, None).count() == 0


def test_smoothing():
    """Chances of all next characters after a context add up to one, and match the recursion written out."""
    words = ["kato", "kami", "tokato", "ruka", "sen", "kamika", "toru", "loka"]
    counts = Counter(g for w in words for g in language.grams_of(w))
    models = language.fit([("aa", g, n) for g, n in counts.items()])
    levels = {language.ORDER: {g: n for g, n in counts.items() if len(g) == language.ORDER}}
    for k in range(language.ORDER - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
        levels[k].update({g: n for g, n in counts.items() if len(g) == k})
    levels = {k: {g: n for g, n in v.items() if g != language.START} for k, v in levels.items()}
    alphabet = {g for g in levels[1]}

    def chance(context, c):
        p = 1 / (len(alphabet) + 1)
        for k in range(1, len(context) + 2):
            level, ctx = levels[k], context[len(context) - k + 1:]
            total = sum(n for g, n in level.items() if g[:-1] == ctx)
            ones, twos = (sum(n == x for n in level.values()) for x in (1, 2))
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            if total:
                kinds = sum(g[:-1] == ctx for g in level)
                p = max(level.get(ctx + c, 0) - d, 0) / total + d * kinds / total * p if ctx + c in level else d * kinds / total * p
        return p

    for word in ("kato", "ruto", "xka"):
        framed = language.START + word + language.STOP
        want = -sum(math.log2(chance(framed[max(0, i - 3):i], framed[i])) for i in range(1, len(framed)))
        bits, chars = models.word_bits([word])
        assert chars[0] == len(word) + 1 and abs(bits[0, 0] - want) < 1e-9


def wide_language(dice, rows):
    """Rows of a language with more sequences than models in one piece used to hold."""
    letters = [chr(c) for c in range(0x430, 0x450)] + [chr(c) for c in range(0x561, 0x575)] + ["\U00010428"]
    return [(i, " ".join("".join(dice.choices(letters, k=12)) for _ in range(100)), "hot", "x") for i in range(rows)]


def counted(rows):
    counts = Counter()
    for _, text, lang, _ in rows:
        for word in language.LETTERS.findall(text.lower()):
            counts.update((lang, g) for g in language.grams_of(word))
    return [(*k, n) for k, n in counts.items()]


def test_small_language_beside_one_with_many_sequences(spark):
    dice = random.Random(3)
    rows = wide_language(dice, 700) + [(10_000 + i, text(dice, "bb", 8), "bb", "x") for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    taught = {r.doc_id for r in df.filter(~language.is_held_out()).collect()}
    counts = counted([r for r in rows if r[0] in taught])
    assert len(counts) > 400_000
    models, whole = language.learn(df), language.fit(counts)
    got = language.predict(df.filter("doc_id >= 9990 or doc_id < 20"), models).collect()
    assert len(got) == 60
    texts = {r[0]: (r[1], r[2]) for r in rows}
    for r in got:
        bits, chars = whole.word_bits(texts[r.doc_id][0].split())
        per_character = bits.sum(axis=0) / chars.sum()
        assert r.lang_pred == texts[r.doc_id][1] and abs(r.entropy - per_character.min()) < 1e-9


def test_blocks_change_nothing(spark, found, monkeypatch):
    df, models = found
    assert not models.parts
    monkeypatch.setattr(language, "BLOCK", 300)
    monkeypatch.setattr(language, "AHEAD", 2_000)
    blocks = language.learn(df)
    assert len(blocks.parts) > 5 and max(t.rows.size for p in blocks.parts for t in p.value.added) < 1_000
    first, second = (sorted(map(tuple, language.predict(df, m).collect()), key=repr) for m in (models, blocks))
    for a, b in zip(first, second, strict=True):
        assert (a[:2], a[4]) == (b[:2], b[4]) and a[2:4] == pytest.approx(b[2:4], nan_ok=True)
    assert language.accepted(df, blocks).count() == df.count() - 4


def test_rejection_learns_from_every_row(spark):
    """A rare language in a large table: figures as a plain reading of all rows gives them, and its short texts stay."""
    dice = random.Random(5)
    rows = [(i, text(dice, "aa", 5), "aa", "x") for i in range(12_000)]
    rows += [(20_000 + i, text(dice, "bb", dice.choice((1, 2, 40))), "bb", "x") for i in range(24)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    taught = {r.doc_id for r in df.filter(~language.is_held_out()).collect()}
    models, apart, n = language.learn(df), {}, Counter()
    for place, lang in enumerate(("aa", "bb")):
        own = [models.word_bits(t.split()) for i, t, x, _ in rows if x == lang and i in taught]
        own = [(bits[:, place].sum(), chars.sum()) for bits, chars in own]
        mean = sum(b for b, _ in own) / sum(c for _, c in own)
        assert models.usual[place][0] == pytest.approx(mean)
        apart[lang], n[lang] = sum((b / c - mean) ** 2 * c for b, c in own), len(own)
    for place, lang in enumerate(("aa", "bb")):
        want = math.sqrt((apart[lang] + sum(apart.values()) / sum(n.values())) / (n[lang] + 1))
        assert models.usual[place][1] == pytest.approx(want)
    assert language.accepted(df, models).filter("lang = 'bb'").count() == 24


def test_one_table_scored_once(spark, found):
    """The same as learning first and predicting then; digits of any kind are no letters."""
    df, models = found
    extra = [(9_000 + i, t, None) for i, t in enumerate(("½ ²", "①", "Ⅷ 12 ٣", "½a²b", None, ""))]
    whole = df.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(extra, "doc_id long, text string, lang string"))
    got = sorted(map(tuple, language.identify(whole).collect()), key=repr)
    assert repr(got) == repr(sorted(map(tuple, language.predict(whole, language.learn(whole)).collect()), key=repr))
    by_id = {r[0]: r for r in got}
    assert [by_id[9_000 + i][1] for i in (0, 1, 2, 4, 5)] == ["und"] * 5 and by_id[9_003][1] != "und"
    kept = language.acceptable(whole.withColumn("_extra", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "lang", "_extra"]
    assert kept.count() == sum(not r[4] for r in got)
    assert language.acceptable(whole.withColumn("lang", F.lit(None).cast("string"))).count() == 0


def test_runs_of_letters():
    assert language.letter_runs("a1b ½c²d_e é①x") == ["a", "b", "c", "d", "e", "é", "x"]
    assert language.letter_runs("½ ² ①") == []
