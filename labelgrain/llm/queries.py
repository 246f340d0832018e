"""The registered queries: each operator over its whole table, at production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgrain.llm.co_training import quality_scores
from labelgrain.llm.decontamination import benchmark_overlaps
from labelgrain.llm.exact_dedup import exact_groups
from labelgrain.llm.jaccard_join import similar_groups
from labelgrain.llm.language_id import identify_languages
from labelgrain.llm.line_dedup import repeated_lines
from labelgrain.llm.lz_fingerprint import neighbour_likeness
from labelgrain.llm.packing import pack_sequences
from labelgrain.llm.spelling import document_variants
from labelgrain.llm.suffix_dedup import repeat_digests
from labelgrain.llm.token_counts import redacted_counts
from labelgrain.llm.tool_calls import TURN_SCHEMAS, link_tool_calls, turns_as_calls
from labelgrain.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_lines(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_sequences(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), added=True)


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_tool_calls(*turns_as_calls(table(spark, sf_dir, "conversations")), TURN_SCHEMAS)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redacted_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), added=True)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_variants(table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the contract's deviation is a long; beyond its range it is null
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op13_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbour_likeness(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_line_dedup, op2_best_fit_packing, op3_suffix_dedup, op4_decontamination, op5_tool_calls, op6_exact_dedup, op7_quality_classifier, op8_jaccard_join, op9_token_counts, op10_language_id, op11_spelling_variants, op12_embedding_whitening, op13_document_fingerprints)}
