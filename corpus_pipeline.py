"""Corpus pipeline: from `documents` to packed training sequences.

Each stage is a function (spark, docs, sf_dir) -> DataFrame. What it returns
is written as Parquet in the shared checkpoint folder and read back as the
next one's docs. All but the last return the columns of documents; n_chars
follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.llm.bpe import vocabulary
from racelens.llm.common import read, shared
from racelens.llm.line_dedup import dedup_lines
from racelens.llm.minhash import near_duplicates
from racelens.llm.packing import pack
from racelens.llm.toxicity import score, train

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents with a toxicity score of 0.5 or more; those without a doc_id stay.

    A doc_id that occurs more than once goes if one of its texts is toxic.
    """
    found = score(docs, train(docs, read(spark, sf_dir, "labels")))
    toxic = found.where("score >= 0.5 and doc_id is not null").select("doc_id").distinct()
    return docs.join(toxic.hint("merge"), "doc_id", "left_anti").select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that an earlier line repeats, and documents of which nothing else was left.

    Documents without any text to begin with stay.
    """
    kept = dedup_lines(spark, docs.select(COLUMNS)).where("n_dropped = 0 or trim(both ' \t\r\n' from text) <> ''")
    return kept.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long")).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group linked by five-word shingles at a Jaccard index of 0.8.

    Rows without a doc_id or without words link with nothing and stay.
    """
    gone = near_duplicates(spark, docs, k=5, percent=80).where("not kept").select("doc_id").distinct()
    return docs.join(gone.hint("merge"), "doc_id", "left_anti").select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every token of every document, in sequences of at most 2048."""
    return pack(spark, docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("minhash near-dedup", drop_near_duplicates),
    ("best-fit packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(COLUMNS)
    for name, stage in STAGES:
        docs = shared(spark, stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs


#: Neither compression lengths nor byte-pair encoding can be told in SQL; tests/llm/test_pipeline.py checks the stages instead.
ORACLE_SQL = None
