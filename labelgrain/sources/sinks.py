"""Writers. Ordered text goes out as part files whose names keep the order.

A distributed sort reads its input twice, once to choose the ranges; store an
input that is expensive to compute before it is written in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgrain.functions.labels import format_vector
from labelgrain.functions.numbers import python_float_text


def _write_ordered(df: DataFrame, line: Column, order_col: str, path: str, mode: str) -> None:
    df.select(order_col, line.alias("value")).orderBy(order_col).select("value").write.mode(mode).text(path)


def write_label_lines(
    df: DataFrame, path: str, label_col: str = "label", order_col: str = "row_no", mode: str = "overwrite"
) -> None:
    """One label per line in ``order_col`` order, sorted by range across tasks."""
    _write_ordered(df, F.col(label_col).cast("int").cast("string"), order_col, path, mode)


def write_vector_lines(
    df: DataFrame, path: str, vec_col: str = "vector", order_col: str = "row_no", mode: str = "overwrite"
) -> None:
    """One comma-joined vector per line in ``order_col`` order."""
    _write_ordered(df, format_vector(F.col(vec_col)), order_col, path, mode)


def write_probs(
    df: DataFrame, path: str, prob_col: str = "prob", order_col: str = "row_no", mode: str = "overwrite"
) -> None:
    """``(row_no, prob)`` in Parquet; the number is a column, so no sort."""
    kept = df.select(F.col(order_col).cast("bigint").alias("row_no"), F.col(prob_col).cast("float").alias("prob"))
    kept.write.mode(mode).parquet(path)


def score_lines(scores: DataFrame) -> DataFrame:
    """``name:value`` lines from ``line, name, value`` rows, in line order."""
    text = F.concat_ws(":", F.col("name"), python_float_text(F.col("value")))
    return scores.select("line", text.alias("value"))


def write_scores(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A small score table as ``name:value`` lines, in line order."""
    score_lines(scores).orderBy("line").select("value").write.mode(mode).text(path)


def append_metrics(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Append log rows. CSV part files carry a header each."""
    writer = df.write.mode("append").format(file_format)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def record_metrics(df: DataFrame, path: str, keys: Sequence[str] = ("epoch",)) -> None:
    """Add log rows, each in place of any earlier one with its ``keys``.

    The keys name folders, and only those of ``df`` are written anew, so a job
    that is tried again leaves no row twice. Every folder has one file; rows of
    ``df`` alike in their keys are kept as they are. A null key has a folder of its own.
    """
    writer = df.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


def recorded_metrics(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """What ``record_metrics`` has written, or None if nothing was."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
