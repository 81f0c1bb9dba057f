"""One query per operator, with its contract's columns, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martflow.llm import (alignment, bpe, collocations, decontaminate, language_id, near_dedup, quality, sentencepiece_viterbi, sharding, simhash,
                          token_records, tool_calls, toxicity)
from martflow.llm.common import crc32_of_id, stored, table

Query = Callable[[SparkSession, str], DataFrame]
WORD_TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def held_out(folds: int, fold: int):
    return F.pmod(crc32_of_id(), F.lit(folds)) == fold


def op1_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = token_records.write(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))
    return token_records.digests(folder, manifest)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", folds=5, held=0))
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract columns, then what is within the radius of every fiftieth document (itself included; else null).

    ``n_within_radius`` counts rows, ``within_radius`` lists their fingerprints with the distance; the rows of
    the result that have a listed fingerprint are the documents found.
    """
    rows = simhash.compare_in_order(table(spark, sf_dir, "documents"))
    rows = stored(rows, "compared")
    asked = rows.where(F.pmod("doc_id", F.lit(50)) == 0)
    near = stored(simhash.within(asked, rows), "within").withColumnRenamed("fp", "__fp")
    counted = asked.join(near, asked.fp == near["__fp"]).select(
        *rows.columns, F.col("n").alias("n_within_radius"), F.col("found").alias("within_radius"))
    rest = rows.where(F.col("doc_id").isNull() | (F.pmod("doc_id", F.lit(50)) != 0)).withColumn(
        "n_within_radius", F.lit(None).cast("long")).withColumn(
        "within_radius", F.lit(None).cast(near.schema["found"].dataType))
    return counted.union(rest).select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("fp")).alias("fingerprint"),
        F.lower(F.hex("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next", "n_within_radius",
        "within_radius")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(table(spark, sf_dir, "documents"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs, language_id.fit(docs, folds=3, held=1))
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "lang_pred", "score")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op7_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = tool_calls.from_conversations(table(spark, sf_dir, "conversations"))
    return tool_calls.link(calls, results, tool_calls.schema_table(spark))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels"), "quality", folds=3, held=1))
    return found.select("doc_id", held_out(3, 1).alias("held_out"), "score",
                        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and whether they decode to it."""
    return sentencepiece_viterbi.encode_rows(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    files = public_tokenizers.path(BYTE_TOKENIZER), public_tokenizers.path(PIECES)
    return alignment.align_rows(docs, *files, alignment.count_pairs(docs, *files))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_TOKENIZER))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_token_records, op2_toxicity, op3_document_fingerprints, op4_simhash_near_dedup, op5_language_id, op6_decontamination, op7_tool_call_linking,
    op8_quality, op9_sentencepiece, op10_sharding, op11_alignment, op12_bpe, op13_collocations)}

ORACLE: dict[str, str] = {"op6_decontamination": decontaminate.ORACLE, "op7_tool_call_linking": tool_calls.ORACLE,
                          "op13_collocations": collocations.ORACLE}
