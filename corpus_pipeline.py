"""A training corpus from ``documents``: five operators, one after the other.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept.  Stages that run Python hand it batches of at most a few megabytes.  The stages before the last return the columns of ``documents``; the
last returns each remaining document with its token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martflow.llm import decontaminate, language_id, near_dedup, quality, sentencepiece_viterbi
from martflow.llm.common import small_batches, stored, table

SHINGLE_WORDS = 4
MAX_BITS = 4


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose compression score says good."""
    small_batches(spark)
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents mostly in one learned language."""
    small_batches(spark)
    return language_id.keep_languages(docs, language_id.fit(docs))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    small_batches(spark)
    return near_dedup.keep_one(docs, SHINGLE_WORDS, MAX_BITS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents with their ids, and whether these decode to the text."""
    small_batches(spark)
    return sentencepiece_viterbi.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("language ID", language_identification),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("SentencePiece encoding and decoding", sentencepiece_encoding),
]

# Classifiers, a perfect code and Viterbi search are beyond SQL; tests compare the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return docs
