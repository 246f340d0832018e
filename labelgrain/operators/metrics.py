"""Scores of predictions against gold labels.

All metrics come from one pass that counts ``tp, fp, fn, tn`` as integers; the
partial counts are combined before the shuffle, so a group that holds a third
of all rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelgrain.fixed_values import FOCAL_GAMMA, LABEL_SMOOTHING, LENGTH_EDGES, LENGTH_LABELS, VECTOR_NAMES
from labelgrain.functions import numbers as N
from labelgrain.functions.labels import fail_when

COUNTS = ("tp", "fp", "fn", "tn")


def count_exprs(gold: Column, pred: Column) -> list[Column]:
    """The four confusion counts, with class 1 as the positive one."""
    return [
        F.count_if((pred == 1) & (gold == 1)).alias("tp"),
        F.count_if((pred == 1) & (gold != 1)).alias("fp"),
        F.count_if((pred != 1) & (gold == 1)).alias("fn"),
        F.count_if((pred != 1) & (gold != 1)).alias("tn"),
    ]


def confusion_counts(
    df: DataFrame, label_col: str, pred_col: str, group_cols: Sequence[str] = ()
) -> DataFrame:
    """The counts, overall or per group; raises at a label or prediction that is neither 0 nor 1."""
    bad = ~(F.col(label_col).isin(0, 1) & F.col(pred_col).isin(0, 1))
    message = F.concat_ws(" ", F.lit("label and prediction must be 0 or 1, not"), *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in (label_col, pred_col)))
    df = df.where(fail_when(F.coalesce(bad, F.lit(True)), message, F.lit(True)))
    return df.groupBy(*group_cols).agg(*count_exprs(F.col(label_col), F.col(pred_col)))


def _scores(tp: Column, fp: Column, fn: Column) -> list[Column]:
    return [
        N.precision(tp, fp).alias("precision"),
        N.recall(tp, fn).alias("recall"),
        N.f1(tp, fp, fn).alias("f1"),
    ]


def binary_scores(
    df: DataFrame, label_col: str, pred_col: str, group_cols: Sequence[str] = ()
) -> DataFrame:
    """Counts, precision, recall and F1 of class 1, overall or per group."""
    counts = confusion_counts(df, label_col, pred_col, group_cols)
    return counts.select(*group_cols, *COUNTS, *_scores(F.col("tp"), F.col("fp"), F.col("fn")))


def multilabel_scores(
    df: DataFrame, gold_vec: str, pred_vec: str, names: Sequence[str] = VECTOR_NAMES
) -> DataFrame:
    """F1 per vector position and the plain mean of all positions (``avg``).

    Three conditional counts per position in one aggregate row, so vectors are
    not exploded and only one row per task is shuffled.
    """
    parts = [F.count(F.lit(1)).alias("n")]
    for i, _ in enumerate(names):
        gold, pred = F.col(gold_vec)[i] == 1, F.col(pred_vec)[i] == 1
        parts += [
            F.count_if(gold & pred).alias(f"both{i}"),
            F.count_if(gold).alias(f"gold{i}"),
            F.count_if(pred).alias(f"pred{i}"),
        ]
    counts = df.agg(*parts)
    both, gold, pred = ([F.col(f"{c}{i}") for i, _ in enumerate(names)] for c in ("both", "gold", "pred"))
    cells = [
        {"tp": b, "fp": p - b, "fn": g - b, "tn": F.col("n") - g - p + b} for b, g, p in zip(both, gold, pred)
    ]
    f1s = [N.f1(c["tp"], c["fp"], c["fn"]) for c in cells]
    rows = [
        F.struct(
            F.lit(i).alias("position"), F.lit(name).alias("label"),
            *[cells[i][c].alias(c) for c in COUNTS], f1s[i].alias("f1"),
        )
        for i, name in enumerate(names)
    ]
    total = f1s[0]
    for value in f1s[1:]:
        total = total + value
    no_count = [F.lit(None).cast("bigint").alias(c) for c in COUNTS]
    rows.append(
        F.struct(
            F.lit(len(names)).alias("position"), F.lit("avg").alias("label"), *no_count,
            (total / F.lit(float(len(names)))).alias("f1"),
        )
    )
    return counts.select(F.inline(F.array(*rows)))


def classification_report(
    df: DataFrame, label_col: str, pred_col: str, names: Sequence[str] = ("negative", "positive")
) -> DataFrame:
    """Per class, accuracy, macro and weighted average, in report order."""
    tp, fp, fn, tn = (F.col(c) for c in COUNTS)
    n0, n1 = tn + fp, tp + fn
    n = n0 + n1
    class0 = (N.precision(tn, fn), N.recall(tn, fp), N.f1(tn, fn, fp))
    class1 = (N.precision(tp, fp), N.recall(tp, fn), N.f1(tp, fp, fn))
    macro = tuple((a + b) / 2.0 for a, b in zip(class0, class1))
    weighted = tuple(N.ratio(a * n0 + b * n1, n) for a, b in zip(class0, class1))
    none = F.lit(None).cast("double")
    lines = [
        (names[0], class0, n0),
        (names[1], class1, n1),
        ("accuracy", (none, none, N.ratio(tp + tn, n)), n),
        ("macro avg", macro, n),
        ("weighted avg", weighted, n),
    ]
    rows = [
        F.struct(
            F.lit(i).alias("line"), F.lit(name).alias("label"), p.alias("precision"),
            r.alias("recall"), f.alias("f1"), support.alias("support"),
        )
        for i, (name, (p, r, f), support) in enumerate(lines)
    ]
    return confusion_counts(df, label_col, pred_col).select(F.inline(F.array(*rows)))


def confusion_matrix(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """Row count of every (gold, pred) cell of the 2x2 grid, empty cells too."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = [
        F.struct(
            F.lit(g).alias("gold"), F.lit(p).alias("pred"), F.lit(c.upper()).alias("cell"),
            F.col(c).alias("n"),
        )
        for g, p, c in cells
    ]
    return confusion_counts(df, label_col, pred_col).select(F.inline(F.array(*rows)))


def group_metrics(df: DataFrame, group_col: str, label_col: str, pred_col: str) -> DataFrame:
    """Metrics per group, flagged where a group's F1 is below the overall one.

    The overall F1 covers rows without a group as well. It is a scalar subquery
    over the same grouped counts. It names all of them, and groups are filtered
    by a count, so that both sides plan one aggregate and share its shuffle.
    """
    counts = ("total", "keyed", "tp", "fp", "fn")
    grouped = df.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("total"),
        F.count(group_col).alias("keyed"),
        *count_exprs(F.col(label_col), F.col(pred_col))[:3],
    )
    overall = grouped.agg(F.struct(*[F.sum(c).alias(c) for c in counts]).alias("sums")).scalar()
    overall_f1 = N.f1(overall["tp"], overall["fp"], overall["fn"])
    positives = F.col("tp") + F.col("fn")
    p = N.precision(F.col("tp"), F.col("fp"))
    r = N.recall(F.col("tp"), F.col("fn"))
    f1 = N.half_even(N.harmonic_f1(p, r), 3)
    return (
        grouped.where(F.col("keyed") > 0)
        .select(
            group_col, "total", positives.alias("positives"),
            N.half_even(100.0 * positives / F.col("total"), 1).alias("positive_pct"),
            N.half_even(p, 3).alias("precision"),
            N.half_even(r, 3).alias("recall"),
            f1.alias("f1"),
            (f1 < overall_f1).alias("below_overall"),
        )
        .orderBy("f1", group_col)
    )


def length_bin_errors(
    df: DataFrame, count_col: str, label_col: str, pred_col: str,
    edges: Sequence[int] = LENGTH_EDGES, labels: Sequence[str] = LENGTH_LABELS,
) -> DataFrame:
    """Miss and false-alarm rates per right-closed length bin, in bin order.

    Rows outside all bins are left out. Without positives the miss rate is 0.0,
    without negatives the false-alarm rate is null.
    """
    binned = df.withColumn("bin", N.bin_ordinal(F.col(count_col), tuple(edges)))
    gold, pred = F.col(label_col), F.col(pred_col)
    # the group outside all bins goes by its count, not by a filter on the bin:
    # that would move below the aggregate and repeat the token count per edge
    grouped = binned.groupBy("bin").agg(
        F.count("bin").alias("inside"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(gold == 1).alias("positives"),
        F.count_if((gold == 1) & (pred == 0)).alias("missed"),
        F.count_if(gold == 0).alias("negatives"),
        F.count_if((gold == 0) & (pred == 1)).alias("alarms"),
    )
    return grouped.where(F.col("inside") > 0).select(
        "bin",
        N.bin_label(F.col("bin"), tuple(labels)).alias("length_bin"),
        "n",
        "positives",
        N.half_even(N.ratio(F.col("missed"), F.col("positives")), 3).alias("fn_rate"),
        N.half_even(F.try_divide(F.col("alarms").cast("double"), F.col("negatives").cast("double")), 3).alias("fp_rate"),
    ).orderBy("bin")


def dataset_loss(
    df: DataFrame, score_col: str, label_col: str, weights: DataFrame,
    gamma: float = FOCAL_GAMMA, smoothing: float = LABEL_SMOOTHING, log_odds: bool = False,
) -> DataFrame:
    """Mean class-weighted focal loss of a scored two-class table.

    ``score_col`` is the probability of class 1, or its log-odds, which keep what
    a probability near 0 or 1 loses. A row without a loss raises.

    ``weights`` has ``label`` and ``weight``. Only its rows for classes 0 and 1
    take part, folded into one row and read as a scalar, so nothing is joined.
    """
    two = weights.where(F.col("label").isin(0, 1)).groupBy().agg(
        F.struct(
            F.max(F.when(F.col("label") == 0, F.col("weight"))).alias("w0"),
            F.max(F.when(F.col("label") == 1, F.col("weight"))).alias("w1"),
        ).alias("w")
    )
    gold = F.col(label_col)
    weight = two.scalar()
    alpha = F.when(gold == 1, weight["w1"]).otherwise(weight["w0"])
    margin = F.col(score_col).cast("double") if log_odds else N.margin_of(F.col(score_col))
    loss = N.focal_loss(margin, gold, alpha, gamma, smoothing)
    whole = fail_when(loss.isNull() | F.isnan(loss), "a row has no loss: no score, label or class weight", loss)
    return df.agg(F.avg(whole).alias("loss"), F.count(F.lit(1)).alias("n"))
