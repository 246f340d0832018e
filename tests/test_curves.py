import random
import struct

import pytest
from pyspark.sql import functions as F

from labelgrain.operators import curves, trials


def f32(x):
    return struct.unpack("f", struct.pack("f", x))[0]


def scored(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"score {kind}, label int")


def brute_f1(rows, threshold):
    tp = sum(1 for s, y in rows if f32(s) >= f32(threshold) and y == 1)
    fp = sum(1 for s, y in rows if f32(s) >= f32(threshold) and y == 0)
    fn = sum(1 for s, y in rows if f32(s) < f32(threshold) and y == 1)
    return tp, fp, fn, 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0


def test_grid():
    grid = curves.threshold_grid()
    assert len(grid) == 80 and grid[0] == 0.1 and grid[-1] == 0.8899999999999996
    for logged in (0.5499999999999998, 0.46999999999999986, 0.6899999999999997, 0.5999999999999998,
                   0.5899999999999997, 0.12, 0.11, 0.21999999999999995, 0.16999999999999998):
        assert logged in grid


def test_sweep_equals_direct_scoring_at_every_threshold(spark):
    rng = random.Random(5)
    grid = curves.threshold_grid()
    rows = [(rng.random(), rng.randint(0, 1)) for _ in range(400)]
    rows += [(f32(t), rng.randint(0, 1)) for t in grid] + [(0.0, 1), (1.0, 0), (-5.0, 1), (7.0, 1)]
    got = curves.threshold_sweep(scored(spark, rows), "score", "label").orderBy("threshold").collect()
    assert [r["threshold"] for r in got] == grid
    for r in got:
        assert (r["tp"], r["fp"], r["fn"], r["f1"]) == brute_f1(rows, r["threshold"])


def test_sweep_by_group_equals_separate_sweeps(spark):
    rng = random.Random(6)
    rows = [(rng.choice("ab"), rng.random(), rng.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "g string, score float, label int")
    both = curves.threshold_sweep(df, "score", "label", ["g"])
    for g in "ab":
        alone = curves.threshold_sweep(df.where(F.col("g") == g), "score", "label").orderBy("i").collect()
        assert both.where(F.col("g") == g).orderBy("i").drop("g").collect() == alone


def test_nan_scores_pass_no_threshold(spark):
    got = curves.threshold_sweep(scored(spark, [(float("nan"), 1), (0.5, 1)]), "score", "label").first()
    assert (got["tp"], got["fn"]) == (1, 1)


def test_best_threshold(spark):
    tied = curves.threshold_sweep(scored(spark, [(0.125, 1), (0.05, 0)]), "score", "label")
    assert tuple(curves.best_threshold(tied).first()) == (0.1, 1.0)
    hopeless = curves.threshold_sweep(scored(spark, [(0.4, 0), (0.3, 0)]), "score", "label")
    assert tuple(curves.best_threshold(hopeless).first()) == (0.5, 0.0)


def brute_curve(rows):
    positives = sum(y for _, y in rows)
    out = []
    for t in sorted({s for s, _ in rows}):
        tp = sum(y for s, y in rows if s >= t)
        fp = sum(1 - y for s, y in rows if s >= t)
        out.append((t, tp, fp, tp / (tp + fp), tp / positives if positives else 1.0))
    return out


@pytest.mark.parametrize("ranges", [1, 2, 7, 50])
def test_curve_equals_a_single_pass(spark, ranges):
    rng = random.Random(7)
    rows = [(round(rng.random() ** 4, 3), int(rng.random() < 0.3)) for _ in range(600)] + [(0.0, 0)] * 300
    curve = curves.pr_curve(scored(spark, rows, "double").repartition(5), "score", "label", ranges)
    points = curve.where(F.col("threshold").isNotNull()).orderBy("threshold").collect()
    got = [(p["threshold"], p["tp"], p["fp"], p["precision"], p["recall"]) for p in points]
    assert got == brute_curve(rows)
    end = curve.where(F.col("threshold").isNull()).collect()
    assert [(e["precision"], e["recall"]) for e in end] == [(1.0, 0.0)]
    area, before = 0.0, 0.0
    for _, _, _, precision, recall in reversed(got):
        area, before = area + (recall - before) * precision, recall
    assert curves.average_precision(curve).first()[0] == pytest.approx(area)


def test_worked_curve(spark):
    df = scored(spark, [(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)], "double")
    curve = curves.pr_curve(df, "score", "label")
    got = [(p["threshold"], p["precision"], p["recall"]) for p in curve.orderBy(F.col("threshold").asc_nulls_last()).collect()]
    assert got == [(0.1, 0.5, 1.0), (0.7, 2 / 3, 1.0), (0.8, 0.5, 0.5), (0.9, 1.0, 0.5), (None, 1.0, 0.0)]
    assert curves.average_precision(curve).first()[0] == pytest.approx(5 / 6)
    assert tuple(curves.operating_point(curve, 0.75).first()) == (0.7, 2 / 3, 1.0) or abs(0.75 - 0.7) > abs(0.8 - 0.75)
    assert tuple(curves.operating_point(curve, 0.12).first()) == (0.1, 0.5, 1.0)


def test_operating_point_takes_the_lower_of_two(spark):
    curve = curves.pr_curve(scored(spark, [(0.25, 1), (0.75, 0)], "double"), "score", "label")
    assert curves.operating_point(curve, 0.5).first()["threshold"] == 0.25


def test_curve_without_positives(spark):
    curve = curves.pr_curve(scored(spark, [(0.25, 0), (0.75, 0)]), "score", "label")
    assert [p["recall"] for p in curve.where(F.col("threshold").isNotNull()).collect()] == [1.0, 1.0]
    assert curves.average_precision(curve).first()[0] == 0.0


LOG = [  # the logged tuned F1 and threshold of ten epochs
    (0.3611650485436893, 0.5499999999999998), (0.45774647887323944, 0.46999999999999986),
    (0.5226666666666666, 0.6899999999999997), (0.5439560439560439, 0.5999999999999998),
    (0.5527272727272727, 0.5899999999999997), (0.5714285714285714, 0.12), (0.5396825396825397, 0.12),
    (0.5319148936170213, 0.11), (0.5515151515151515, 0.21999999999999995), (0.5352112676056338, 0.16999999999999998),
]


def test_trial_log(spark):
    rows = [("r", i + 1, f1, t) for i, (f1, t) in enumerate(LOG)]
    log = spark.createDataFrame(rows, "run string, epoch int, best_tuned_f1 double, threshold double")
    best = trials.best_trial(log.drop("run")).first()
    assert (best["epoch"], best["threshold"]) == (6, 0.12)
    flags = [r["improved"] for r in trials.best_so_far(log, "run").orderBy("epoch").collect()]
    assert flags == [True] * 6 + [False] * 4


def test_earliest_of_equal_trials_wins(spark):
    log = spark.createDataFrame([(1, 0.0, 0.5), (2, 0.4, 0.3), (3, 0.4, 0.2)], "epoch int, best_tuned_f1 double, threshold double")
    assert trials.best_trial(log).first()["epoch"] == 2
    got = trials.best_so_far(log.withColumn("run", F.lit(1)), "run").orderBy("epoch").collect()
    assert [r["improved"] for r in got] == [False, True, False]


@pytest.mark.parametrize("missing", [None, float("nan")])
def test_missing_scores_raise_with_any_number_of_ranges(spark, missing):
    df = spark.createDataFrame([(0.9, 1), (0.1, 0), (missing, 1)], "score double, label int")
    for ranges in (1, 4):
        with pytest.raises(Exception, match="score is missing"):
            curves.pr_curve(df, "score", "label", ranges).collect()


def test_curve_and_area_do_not_depend_on_ranges(spark):
    df = spark.createDataFrame([(i * 37 % 101 / 101, i % 3 % 2) for i in range(300)], "score double, label int")
    results = []
    for ranges in (1, 2, 4, 200):
        curve = curves.pr_curve(df, "score", "label", ranges)
        results.append((sorted(map(repr, curve.collect())), round(curves.average_precision(curve).first()[0], 12)))
    assert all(r == results[0] for r in results)
