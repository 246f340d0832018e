"""Score a submission folder against a gold folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgrain.fixed_values import TASK_FILES
from labelgrain.operators.metrics import binary_scores, multilabel_scores
from labelgrain.operators.splits import align
from labelgrain.sources.readers import available_tasks, read_label_lines, read_vector_lines
from labelgrain.sources.sinks import write_scores

SCORE_SCHEMA = "line int, name string, value double"


def named_binary_scores(scores: DataFrame, task: str = "task1") -> DataFrame:
    rows = [
        F.struct(F.lit(i).alias("line"), F.lit(f"{task}_{name}").alias("name"), F.col(name).alias("value"))
        for i, name in enumerate(("precision", "recall", "f1"))
    ]
    return scores.select(F.inline(F.array(*rows)))


def named_vector_scores(scores: DataFrame, task: str = "task2", first_line: int = 3) -> DataFrame:
    return scores.select(
        (F.col("position") + first_line).alias("line"),
        F.concat(F.lit(f"{task}_"), F.col("label")).alias("name"),
        F.col("f1").alias("value"),
    )


def score_submission(spark: SparkSession, ref_dir: str, res_dir: str, out_path: str | None = None) -> DataFrame:
    """``line, name, value`` of every task the submission has a file for.

    The binary task wants files of equal length; the category task ignores
    surplus predictions. ``out_path`` also gets the scores as text lines.
    """
    found = available_tasks(spark, res_dir)
    parts = []
    if "task1" in found:
        gold = read_label_lines(spark, f"{ref_dir}/{TASK_FILES['task1']}")
        pred = read_label_lines(spark, found["task1"], "pred")
        parts.append(named_binary_scores(binary_scores(align(gold, pred), "label", "pred")))
    if "task2" in found:
        gold = read_vector_lines(spark, f"{ref_dir}/{TASK_FILES['task2']}", vec_col="gold")
        pred = read_vector_lines(spark, found["task2"], vec_col="pred")
        parts.append(named_vector_scores(multilabel_scores(align(gold, pred, extra="ignore"), "gold", "pred")))
    scores = reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], SCORE_SCHEMA)
    if out_path:
        write_scores(scores, out_path)
    return scores
