"""Corpus exploration and a coin-flip baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgrain.fixed_values import SEED
from labelgrain.functions.labels import collapse_number, hash_bits, random_bits
from labelgrain.functions.text import coerce_null, word_tokens
from labelgrain.operators import explore
from labelgrain.operators.shared import stored


def corpus_report(graded: DataFrame, grade_col: str = "orig_label", top_k: int = 15) -> dict[str, DataFrame]:
    """Class balance, word counts, histogram and top bigrams of a graded corpus.

    Words are counted once; balance, statistics and histogram share the stored
    classes and counts.
    """
    grade = F.col(grade_col).try_cast("double")
    corpus = graded.withColumn("binary_label", collapse_number(grade))
    n_words = F.size(word_tokens(coerce_null(F.col("text"), "nan")))
    counted = stored(corpus.select("binary_label", n_words.alias("token_count")))
    return {
        "classes": explore.class_distribution(counted, "binary_label"),
        "token_stats": explore.token_stats(counted, "token_count", "binary_label"),
        "histogram": explore.histogram(counted, "token_count", "binary_label"),
        "bigrams": explore.top_ngrams(corpus, "text", "binary_label", k=top_k, order_col="row_no"),
    }


def baseline(rows: DataFrame, width: int = 1, key: str | None = "row_no", seed: int = SEED) -> DataFrame:
    """A 0/1 vector of coin flips per row.

    With a ``key`` the flips follow from key and seed under any partitioning,
    without one they come from Spark's seeded generator.
    """
    flips = hash_bits(F.col(key), width, seed) if key else random_bits(width, seed)
    return rows.withColumn("vector", flips)
