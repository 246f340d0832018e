"""Error analysis of dev predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgrain.fixed_values import NOMINAL_THRESHOLD
from labelgrain.functions.labels import normalise_key, vote_label
from labelgrain.functions.numbers import correct
from labelgrain.functions.text import snippet, ws_token_count
from labelgrain.operators import curves, errors, metrics, splits
from labelgrain.operators.shared import stored
from labelgrain.sources.readers import read_graded, read_label_lines, read_probs, read_split


def load_dev(
    spark: SparkSession, corpus_path: str, split_path: str, pred_path: str, prob_path: str | None = None
) -> DataFrame:
    """Dev rows in list order with vote label, text, prediction and correctness.

    Labels come from the votes in the split list. Predictions belong to rows by
    position; a different number of rows raises. Stored probabilities are added
    as ``prob`` if there are any. Of the texts only the token count and the
    characters that the report shows are kept, and the table is stored, so its
    reports read no file again.
    """
    corpus = read_graded(spark, corpus_path).drop("label", "orig_label")
    corpus = corpus.withColumn("par_id", normalise_key(F.col("par_id")))
    corpus = corpus.withColumns({"token_count": ws_token_count(F.col("text")), "text": snippet(F.col("text"))})
    ids = read_split(spark, split_path).withColumn("label", vote_label(F.col("label")))
    dev = splits.attach_in_order(ids, corpus, "par_id", renumber=True)
    dev = splits.align(dev, read_label_lines(spark, pred_path, "pred"))
    probs = read_probs(spark, prob_path) if prob_path else None
    if probs is not None:
        dev = splits.align(dev, probs)
    return stored(dev.withColumn("correct", correct(F.col("pred"), F.col("label"))))


def error_report(dev: DataFrame, n_examples: int = 8, threshold: float = NOMINAL_THRESHOLD) -> dict[str, DataFrame]:
    """The report's tables by name; the curve's tables only with ``prob``."""
    tables = {
        "scores": metrics.binary_scores(dev, "label", "pred"),
        "confusion": metrics.confusion_matrix(dev, "label", "pred"),
        "by_keyword": metrics.group_metrics(dev, "keyword", "label", "pred"),
        "by_length": metrics.length_bin_errors(dev, "token_count", "label", "pred"),
        "error_totals": errors.error_totals(dev, "label", "pred"),
        "error_sample": errors.error_sample(dev, "row_no", "label", "pred", "text", ["keyword"], n_examples),
        "error_breakdown": errors.error_breakdown(dev, "keyword", "label", "pred"),
    }
    if "prob" in dev.columns:
        curve = curves.pr_curve(dev, "prob", "label")
        tables["pr_curve"] = curve
        tables["average_precision"] = curves.average_precision(curve)
        tables["operating_point"] = curves.operating_point(curve, threshold)
    return tables
