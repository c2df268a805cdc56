"""Corpus pipeline: reject bad documents, drop near duplicates, mix sources to target weights, encode.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; its result is written as
Parquet and read again as the next stage's documents. The first three return the columns of ``documents``; the last
returns doc_id, n_tokens, token_ids and round_trip of every row of the mixed corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import minhash, mixing, pieces, quality
from shelfwise.llm._common import table, written
from shelfwise.llm.queries import vocabulary


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of 0.3 or more)."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity of 0.8 or more."""
    return minhash.drop_near_duplicates(docs, words=5, similarity=(8, 10))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: weights 5, 2, 1 by source, documents repeated three times at most."""
    return mixing.mixed_rows(docs, weights=(5, 2, 1), max_repeats=3)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, checked by decoding."""
    return pieces.encode(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encoding_stage),
]

# The classifier and the piece encoding have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
