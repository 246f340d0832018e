"""A corpus pipeline: language, exact copies, near copies, benchmark leaks, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``. ``run`` writes each stage's result as
Parquet to the shared folder and rereads it for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from labelgrain.llm.decontamination import drop_contaminated
from labelgrain.llm.exact_dedup import keep_first
from labelgrain.llm.jaccard_join import keep_one_of_similar
from labelgrain.llm.language_id import keep_identified
from labelgrain.llm.packing import pack_sequences
from labelgrain.llm.storage import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has a language; a text that is null or has no letter goes."""
    return keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the smallest id."""
    return keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links of similar texts connect the document with the smallest id."""
    return keep_one_of_similar(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of the documents and their places in training sequences."""
    return pack_sequences(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), added=True)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: Hypervectors, substitution-tolerant overlaps and tokens have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
