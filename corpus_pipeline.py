"""Documents to token ids in five stages, each with one operator of gridloom.llm.

A stage works on all rows that its predecessor kept and returns the columns of documents; the last returns token ids.
Null texts count as empty. doc_id is the key of documents: rows that repeat one are one document, of which one row stays
after the second stage; rows without a doc_id cannot be named by a stage that removes documents, so they stay there.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gridloom.llm import jaccard, language, pieces, secret_scan, tiling
from gridloom.llm.staging import staged, without

PIECES = public_tokenizers.path("piece_bpe_32k.model")
#: Number of a row where ids repeat; no column of the input has this name.
ROW = "_near_duplicates_row"
#: Character models, hash orders and randomness tests have no counterpart in SQL; tests compare with brute force.
ORACLE_SQL = None


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labels of the documents teach; texts without letters or unlike all go.

    Where no document has a label and a text, no language is known and all go.
    """
    return language.acceptable(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8 or more): the smallest doc_id.

    Where a doc_id repeats, groups are those of single rows. A doc_id with unlike texts stands for a group only if no
    other does, and keeps one row if it stands for several. Rows without a doc_id stay.
    """
    named = docs.filter("doc_id is not null")
    if named.groupBy("doc_id").count().filter("count > 1").isEmpty():
        found = jaccard.near_duplicates(docs, words=5, share=4, of=5)
        return without(docs, found.filter("doc_id <> component_id").select("doc_id"))
    rows = staged(docs.withColumn(ROW, F.monotonically_increasing_id()))
    found = jaccard.near_duplicates(rows, words=5, share=4, of=5, key=ROW).select(
        F.col("doc_id").alias(ROW), F.col("component_id").alias("group"), (F.col("n_shingles") == 0).alias("empty"))
    named = staged(rows.filter("doc_id is not null").select(ROW, "doc_id", F.xxhash64("text").alias("hash")).join(found, ROW))
    unlike = named.groupBy("doc_id").agg((F.min("group") < F.max("group")).alias("unlike"))
    heads = named.join(unlike, "doc_id").groupBy("group").agg(
        F.min(F.struct("unlike", "doc_id", "empty", "hash", ROW)).alias("head")).select("head.*")
    stay = heads.groupBy("doc_id").agg(F.min(F.struct("empty", "hash", ROW))[ROW].alias(ROW))
    gone = named.join(stay, ROW, "left_anti").select(ROW)
    return without(rows, gone, ROW).select(docs.columns)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without(docs, tiling.contaminated(docs, benchmark).select("doc_id"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets replaced by a marker; n_chars follows where there is such a column."""
    found = secret_scan.with_secrets(docs)
    clean = found.withColumn("text", secret_scan.redacted(F.col("text"), F.col("secrets")))
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number and digest of each text's ids, digest of what they decode to."""
    return pieces.digests(pieces.piece_round_trip(docs, PIECES))


STAGES = [
    ("language", known_languages), ("near_duplicates", one_of_each), ("decontamination", not_in_benchmark),
    ("secrets", no_secrets), ("pieces", piece_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each on the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
