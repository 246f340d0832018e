"""Listings of wrong predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgrain.fixed_values import SAMPLE_SIZE, SEED, SNIPPET_CHARS
from labelgrain.functions import numbers as N
from labelgrain.functions.text import snippet as first_chars
from labelgrain.operators.shared import top_per_group


def errors(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """The wrong rows, with ``err_type`` ``FP`` or ``FN``."""
    kind = N.error_type(F.col(pred_col), F.col(label_col))
    return df.withColumn("err_type", kind).where(F.col("err_type").isin("FP", "FN"))


def error_totals(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    gold, pred = F.col(label_col), F.col(pred_col)
    return df.agg(
        F.count_if((pred == 1) & (gold == 0)).alias("false_positives"),
        F.count_if((pred == 0) & (gold == 1)).alias("false_negatives"),
    )


def error_breakdown(df: DataFrame, group_col: str, label_col: str, pred_col: str) -> DataFrame:
    """Errors per type and group, most frequent first; null groups are left out."""
    wrong = errors(df, label_col, pred_col).where(F.col(group_col).isNotNull())
    counted = wrong.groupBy("err_type", group_col).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy("err_type", F.desc("n"), group_col)


def error_sample(
    df: DataFrame, key: str, label_col: str, pred_col: str, text_col: str,
    keep_cols: Sequence[str] = (), n: int = SAMPLE_SIZE, seed: int = SEED,
    snippet: int = SNIPPET_CHARS,
) -> DataFrame:
    """Up to ``n`` false positives and ``n`` false negatives without replacement.

    The rows with the smallest MD5 of seed and key are taken: the same rows for
    any partitioning. Only the text's first characters travel to the sort.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    wrong = errors(df, label_col, pred_col).select(
        "err_type", key, *keep_cols, first_chars(F.col(text_col), snippet).alias("snippet"),
        draw.alias("draw"),
    )
    top = top_per_group(wrong, ["err_type"], [F.col("draw"), F.col(key)], n, [key])
    return top.drop("draw").orderBy("err_type", "rank")
