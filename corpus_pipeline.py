"""A cleaning pipeline over ``documents``: five operators of ``virelay.llm``, one after another.

Each stage gets what the one before kept, written as Parquet and read again, and
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from virelay.llm import jaccard_join, langid, line_dedup, sentencepiece_agenda, simhash_decontam
from virelay.llm.common import long_rows, stored

#: Texts in no language at all score less than this; prose of any kind scores far more.
LEAST_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which no language is recognised; fills in missing languages.

    Null, empty and letterless texts go.  Rows are judged one by one, repeated
    rows and null ids included; without any labelled row, all go.
    """
    long_rows(spark)
    columns = docs.columns
    found = langid.predict(docs, langid.train(docs))
    kept = found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*columns)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the lines that ten or more documents hold.

    Every row stays, repeated rows and null ids included, each of which counts
    as a document; null text becomes empty, and ``n_chars`` is counted anew.
    """
    columns = docs.columns
    cut = line_dedup.drop_frequent_lines(docs, min_docs=10)
    rows = cut.select("row.*", "kept").withColumn("text", F.col("kept"))
    return rows.withColumn("n_chars", F.char_length("kept").cast("long")).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group linked by five-word shingles at a similarity of 0.8 or more.

    That of least id (null ids last; ties: the least hash of the text); rows
    alike in id and text are one.  Texts without words link with nothing and stay.
    """
    return jaccard_join.one_of_each(docs, width=5, num=80, den=100)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item.

    Equal texts are judged alike; null and empty ones stay, and so do all where
    the benchmark is empty or its items have fewer than five words.
    """
    return simhash_decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text, and the text that they decode to: a row for each row; null text has none."""
    coded = sentencepiece_agenda.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return coded.withColumnRenamed("id", "doc_id")


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("SentencePiece", sentencepiece),
]

#: Learned profiles, fingerprints and pieces can't be written in SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
