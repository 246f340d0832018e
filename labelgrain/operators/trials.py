"""Reading a log of training trials."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def best_trial(log: DataFrame, run_col: str | None = None) -> DataFrame:
    """The row with the highest tuned F1, the earliest epoch on ties, per run."""
    rest = [c for c in log.columns if c not in ("epoch", "best_tuned_f1", run_col)]
    row = F.struct(F.col("best_tuned_f1"), (-F.col("epoch")).alias("e"), *rest)
    keys = [run_col] if run_col else []
    best = log.groupBy(*keys).agg(F.max(row).alias("b"))
    return best.where(F.col("b").isNotNull()).select(
        *keys, (-F.col("b.e")).alias("epoch"), F.col("b.best_tuned_f1").alias("best_tuned_f1"),
        *[F.col(f"b.{c}").alias(c) for c in rest],
    )


def best_so_far(log: DataFrame, run_col: str) -> DataFrame:
    """Highest tuned F1 of the earlier epochs (0.0 at first) and whether it rose.

    One window per run; a run has as many rows as it has epochs.
    """
    earlier = Window.partitionBy(run_col).orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.max("best_tuned_f1").over(earlier), F.lit(0.0))
    with_best = log.withColumn("best_before", F.greatest(before, F.lit(0.0)))
    return with_best.withColumn("improved", F.col("best_tuned_f1") > F.col("best_before"))
