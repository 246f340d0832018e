"""Ratios, rounding, decisions and report formatting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from labelgrain.fixed_values import (
    DEFAULT_THRESHOLD,
    FOCAL_GAMMA,
    LABEL_SMOOTHING,
    LENGTH_EDGES,
    LENGTH_LABELS,
)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, 0.0 when the denominator is zero."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def precision(tp: Column, fp: Column) -> Column:
    return ratio(tp, tp + fp)


def recall(tp: Column, fn: Column) -> Column:
    return ratio(tp, tp + fn)


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    """F1 from integer counts with a single division."""
    return ratio(2 * tp, 2 * tp + fp + fn)


def harmonic_f1(p: Column, r: Column) -> Column:
    """F1 as the harmonic mean of an already divided precision and recall."""
    return ratio(2 * p * r, p + r)


def half_even(value: Column, digits: int) -> Column:
    """Round the scaled value half to even, the way numpy rounds floats."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def positive_probability(logit0: Column, logit1: Column) -> Column:
    """Softmax probability of class 1 out of two logits."""
    return 1.0 / (1.0 + F.exp(logit0 - logit1))


def decide(prob: Column, threshold: float | Column = DEFAULT_THRESHOLD) -> Column:
    """1 when ``prob >= threshold``, compared in single precision; NaN and null are 0."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    p = prob.cast("float")
    return F.coalesce(~F.isnan(p) & (p >= t.cast("float")), F.lit(False)).cast("int")


def correct(pred: Column, gold: Column) -> Column:
    return (pred == gold).cast("int")


def error_type(pred: Column, gold: Column) -> Column:
    """``TP``, ``FP``, ``FN`` or ``TN``; null for labels outside 0 and 1."""
    return (
        F.when((pred == 1) & (gold == 1), "TP")
        .when((pred == 1) & (gold == 0), "FP")
        .when((pred == 0) & (gold == 1), "FN")
        .when((pred == 0) & (gold == 0), "TN")
    )


def bin_ordinal(value: Column, edges: tuple = LENGTH_EDGES) -> Column:
    """Index of the right-closed bin holding ``value``; null outside all bins."""
    expr = F.lit(None).cast("int")
    for i in reversed(range(len(edges) - 1)):
        expr = F.when((value > edges[i]) & (value <= edges[i + 1]), F.lit(i)).otherwise(expr)
    return expr


def bin_label(ordinal: Column, labels: tuple = LENGTH_LABELS) -> Column:
    return F.get(F.array(*[F.lit(x) for x in labels]), ordinal)


#: The log-odds of the smallest probability that a double can hold.
LARGEST_MARGIN = 745.0


def margin_of(prob: Column) -> Column:
    """Log-odds of a probability; those of 0 and 1 are as far out as a double tells."""
    p = prob.cast("double")
    odds = F.ln(p) - F.log1p(-p)
    return F.when(p == 0, -LARGEST_MARGIN).when(p == 1, LARGEST_MARGIN).otherwise(odds)


def log_probability(margin: Column) -> Column:
    """Log of the probability that has these log-odds, finite for any finite ones."""
    return -(F.greatest(-margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin))))


def focal_loss(
    margin: Column, label: Column, alpha: Column, gamma: float = FOCAL_GAMMA,
    smoothing: float = LABEL_SMOOTHING,
) -> Column:
    """Class-weighted focal loss of one row with smoothed two-class targets.

    ``margin`` is the log-odds of class 1; the probability of the labelled
    class drives both the focusing weight and the cross entropy.
    """
    own = F.when(label == 1, margin).otherwise(-margin)
    entropy = -((1.0 - smoothing) * log_probability(own) + smoothing * log_probability(-own))
    return alpha * F.exp(float(gamma) * log_probability(-own)) * entropy


def fixed_point(value: Column, digits: int, suffix: str = "") -> Column:
    """Text with a fixed number of decimals, rounded half to even on the exact binary value.

    The scaled value is a double and the error of its product, found by
    splitting both factors in halves; the error only matters where the double
    alone lies on a tie. For values whose scaled size is below 2 to the 52nd;
    larger ones have no fraction to round and are printed as they are.
    """
    scale = float(10**digits)
    half = scale * 134217729.0
    scale_high = half - (half - scale)
    scale_low = scale - scale_high

    def rounded(x: Column) -> Column:
        def near(p):
            high = p["carry"] - (p["carry"] - x)
            low = x - high
            error = ((high * scale_high - p["product"]) + high * scale_low + low * scale_high) + low * scale_low
            whole = F.rint(p["product"])
            gap = p["product"] - whole
            return whole + F.when((gap == 0.5) & (error > 0), 1.0).when((gap == -0.5) & (error < 0), -1.0).otherwise(0.0)

        return _let(F.struct((x * scale).alias("product"), (x * 134217729.0).alias("carry")), near)

    def text(x: Column) -> Column:
        figures = F.abs(rounded(x)).cast("decimal(20,0)").cast("string")
        padded = _let(figures, lambda f: F.lpad(f, F.greatest(F.length(f), F.lit(digits + 1)), F.lit("0")))
        pointed = _let(padded, lambda f: F.concat(F.substring(f, F.lit(1), F.length(f) - digits), F.lit("."), F.right(f, F.lit(digits)))) if digits else padded
        sign = F.when(x.cast("string").startswith("-"), "-").otherwise("")
        return (
            F.when(F.isnan(x), "nan")
            .when(F.abs(x) == float("inf"), F.concat(sign, F.lit("inf")))
            .when(F.abs(x * scale) >= float(1 << 52), F.format_string(f"%.{digits}f", x))
            .otherwise(F.concat(sign, pointed))
        )

    return F.concat(_let(value.cast("double"), text), F.lit(suffix))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def python_float_text(value: Column) -> Column:
    """A double below ten million the way Python prints it: no ``E``, exponents from 1e-05 down."""
    text = value.cast("string")
    plain = F.rtrim(value.cast("decimal(38,30)").cast("string"), F.lit("0"))
    tiny = F.regexp_replace(
        F.regexp_replace(text, r"(\.0)?E-(\d)$", "e-0$2"), r"(\.0)?E-(\d\d+)$", "e-$2"
    )
    return (
        F.when(~text.contains("E"), text)
        .when((F.abs(value) >= 1e-4) & (F.abs(value) < 1.0), plain)
        .otherwise(tiny)
    )
