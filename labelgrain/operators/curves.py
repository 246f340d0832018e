"""Threshold sweep, precision-recall curve, average precision."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelgrain.fixed_values import DEFAULT_THRESHOLD, GRID_HIGH, GRID_LOW, GRID_STEP, NOMINAL_THRESHOLD
from labelgrain.functions import numbers as N
from labelgrain.functions.labels import fail_when
from labelgrain.operators.shared import stored


class Grid:
    """The thresholds of ``numpy.arange(lo, hi, step)``, bit for bit."""

    def __init__(self, lo: float, hi: float, step: float):
        self.lo, self.delta = float(lo), (lo + step) - lo
        self.size = math.ceil((hi - lo) / step)

    def level(self, i: Column) -> Column:
        return F.lit(self.lo) + i * F.lit(self.delta)

    def values(self) -> list[float]:
        return [self.lo + i * self.delta for i in range(self.size)]


def threshold_grid(lo: float = GRID_LOW, hi: float = GRID_HIGH, step: float = GRID_STEP) -> list[float]:
    return Grid(lo, hi, step).values()


def _highest_passed(df: DataFrame, score_col: str, grid: Grid) -> DataFrame:
    """Add ``i``, the index of the highest threshold the score reaches, -1 for none.

    The index is guessed from the spacing and put right by one place with the
    single-precision comparison that decides.
    """
    last, score = F.lit(grid.size - 1), F.col(score_col)
    place = F.floor((score.cast("double") - grid.lo) / grid.delta)
    usable = ~F.isnan(score) & score.isNotNull()
    guess = F.when(usable, F.greatest(F.lit(-1), F.least(last, place)).cast("int")).otherwise(-1)
    guessed = df.withColumns({"_p": score.cast("float"), "_g": guess})
    g, p = F.col("_g"), F.col("_p")
    up = (g < last) & (p >= grid.level(g + 1).cast("float")) & ~F.isnan(p)
    down = (g >= 0) & (p < grid.level(g).cast("float"))
    return guessed.withColumn("i", F.when(up, g + 1).when(down, g - 1).otherwise(g)).drop("_p", "_g")


def threshold_sweep(
    df: DataFrame, score_col: str, label_col: str, group_cols: Sequence[str] = (),
    lo: float = GRID_LOW, hi: float = GRID_HIGH, step: float = GRID_STEP,
) -> DataFrame:
    """Counts and F1 at every grid threshold, from one pass over the rows.

    Each row counts once, at the highest threshold it reaches; running sums over
    these few counts give the whole grid. Groups sweep side by side.
    """
    grid = Grid(lo, hi, step)
    rows = df.select(*group_cols, F.col(score_col).alias("score"), (F.col(label_col) == 1).alias("gold"))
    indexed = _highest_passed(rows, "score", grid)
    counted = indexed.groupBy(*group_cols, "i").agg(
        F.count_if(F.col("gold")).alias("pos"), F.count_if(~F.col("gold")).alias("neg")
    )
    # at most one entry per threshold and one for "none", so the maps are bounded
    folded = counted.groupBy(*group_cols).agg(
        F.map_from_entries(F.collect_list(F.struct("i", "pos"))).alias("pos_at"),
        F.map_from_entries(F.collect_list(F.struct("i", "neg"))).alias("neg_at"),
        F.sum("pos").alias("all_pos"),
        F.sum("neg").alias("all_neg"),
    )
    places = F.sequence(F.lit(0), F.lit(grid.size - 1))
    filled = folded.select(*group_cols, "pos_at", "neg_at", "all_pos", "all_neg", F.explode(places).alias("i"))
    lower = Window.partitionBy(*(group_cols or [F.lit(0)])).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)

    def missed(counts: str) -> Column:
        """Rows below a threshold: those that reach none and those of lower ones."""
        zero = F.lit(0).cast("bigint")
        here = F.coalesce(F.try_element_at(F.col(counts), F.col("i")), zero)
        none = F.coalesce(F.try_element_at(F.col(counts), F.lit(-1)), zero)
        return none + F.coalesce(F.sum(here).over(lower), zero)

    summed = filled.select(
        *group_cols, "i", grid.level(F.col("i")).alias("threshold"),
        (F.col("all_pos") - missed("pos_at")).alias("tp"),
        (F.col("all_neg") - missed("neg_at")).alias("fp"),
        missed("pos_at").alias("fn"),
    )
    return summed.withColumn("f1", N.f1(F.col("tp"), F.col("fp"), F.col("fn")))


def best_threshold(sweep: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """The lowest threshold of the highest F1; 0.5 and 0.0 if no F1 is above 0."""
    best = sweep.groupBy(*group_cols).agg(
        F.max(F.struct(F.col("f1"), (-F.col("threshold")).alias("t"))).alias("best")
    )
    useful = F.col("best.f1") > 0
    return best.select(
        *group_cols,
        F.when(useful, -F.col("best.t")).otherwise(F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
        F.when(useful, F.col("best.f1")).otherwise(F.lit(0.0)).alias("f1"),
    )


def _range_bounds(counts: DataFrame, ranges: int) -> list[float]:
    """At most ``ranges - 1`` ascending cut points of about equal row counts."""
    if ranges < 2:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    cuts = counts.agg(F.percentile_approx("score_d", shares, max(10000, 10 * ranges)).alias("c")).first()["c"] or []
    return sorted({c for c in cuts if math.isfinite(c)})


def score_counts(df: DataFrame, score_col: str, label_col: str) -> DataFrame:
    """Rows and positives of every distinct score: ties collapse before any sort.

    A score that is null or NaN raises.
    """
    score = F.col(score_col)
    missing = score.isNull() | F.isnan(score.cast("double"))
    scored = df.select(fail_when(missing, "a score is missing", score).alias("score"), (F.col(label_col) == 1).alias("gold"))
    return scored.groupBy("score").agg(
        F.count_if(F.col("gold")).alias("positives"), F.count_if(~F.col("gold")).alias("negatives")
    )


def pr_curve(
    df: DataFrame, score_col: str, label_col: str, ranges: int | None = None
) -> DataFrame:
    """One point per distinct score, plus the end point (precision 1, recall 0).

    The cumulative counts are a two-level prefix sum. The distinct scores are
    stored once and cut into ranges of about equal size; every range's total is
    shifted onto the ranges below it, and windows only run inside a range. Which
    range a score belongs to is a function of the score, so a recomputed task
    gives the same answer. ``ranges`` defaults to the shuffle partitions.
    Without positives recall is 1 everywhere.
    """
    spark = df.sparkSession
    counts = stored(score_counts(df, score_col, label_col)).withColumn("score_d", F.col("score").cast("double"))
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = _range_bounds(counts, ranges)
    if cuts:
        splits = [float("-inf"), *cuts, float("inf")]
        bucketed = Bucketizer(splits=splits, inputCol="score_d", outputCol="range").transform(counts)
    else:
        bucketed = counts.withColumn("range", F.lit(0.0))

    # one row per range, at most ``ranges`` of them: small by construction
    totals = bucketed.groupBy("range").agg(
        F.sum("positives").alias("pos"), F.sum("negatives").alias("neg")
    )
    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    zero = F.lit(0).cast("bigint")
    offsets = totals.select(
        "range",
        F.coalesce(F.sum("pos").over(above), zero).alias("pos_above"),
        F.coalesce(F.sum("neg").over(above), zero).alias("neg_above"),
        F.sum("pos").over(everything).alias("all_pos"),
    )
    inside = Window.partitionBy("range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    tp = F.col("pos_above") + F.sum("positives").over(inside)
    fp = F.col("neg_above") + F.sum("negatives").over(inside)
    points = bucketed.join(F.broadcast(offsets), "range").select(
        "score", "positives", tp.alias("tp"), fp.alias("fp"), "all_pos"
    )
    no_positives = F.col("all_pos") == 0
    curve = points.select(
        F.col("score").alias("threshold"), "tp", "fp", "positives",
        N.precision(F.col("tp"), F.col("fp")).alias("precision"),
        F.when(no_positives, F.lit(1.0)).otherwise(N.ratio(F.col("tp"), F.col("all_pos"))).alias("recall"),
    )
    none = F.lit(None).cast("bigint")
    end = spark.range(1).select(
        F.lit(None).cast(df.schema[score_col].dataType).alias("threshold"), none.alias("tp"), none.alias("fp"),
        none.alias("positives"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
    )
    return curve.unionByName(end)


def average_precision(curve: DataFrame) -> DataFrame:
    """Step-wise area under the curve, without interpolation.

    The recall gained at a point is its own positives over all positives, so
    neighbouring points need not be lined up; one aggregate is enough.
    """
    area = F.sum(F.col("positives") * F.col("precision"))
    return curve.agg(N.ratio(area, F.max("tp")).alias("average_precision"))


def operating_point(curve: DataFrame, threshold: float = NOMINAL_THRESHOLD) -> DataFrame:
    """The curve point with the threshold nearest to the given one, lowest on ties."""
    kind = curve.schema["threshold"].dataType
    distance = F.abs(F.col("threshold") - F.lit(float(threshold)).cast(kind))
    near = curve.where(F.col("threshold").isNotNull()).agg(
        F.min(
            F.struct(distance.alias("d"), F.col("threshold"), F.col("precision"), F.col("recall"))
        ).alias("p")
    )
    return near.select("p.threshold", "p.precision", "p.recall")
