import random

import pytest
from pyspark.sql import functions as F

from labelgrain.fixed_values import VECTOR_NAMES
from labelgrain.operators import errors, metrics, splits

GOLDEN = {"tp": 108, "fp": 121, "fn": 41, "tn": 1824}


@pytest.fixture(scope="module")
def golden(spark):
    cells = {"tp": (1, 1), "fp": (0, 1), "fn": (1, 0), "tn": (0, 0)}
    rows = [cells[c] for c, n in GOLDEN.items() for _ in range(n)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_no bigint, label int, pred int")


def test_published_scores(golden):
    got = metrics.binary_scores(golden.repartition(5), "label", "pred").first().asDict()
    assert {c: got[c] for c in GOLDEN} == GOLDEN
    assert (got["precision"], got["recall"], got["f1"]) == (0.47161572052401746, 0.7248322147651006, 0.5714285714285714)


def test_confusion_matrix_has_all_cells(spark, golden):
    cells = {(r["gold"], r["pred"]): r["n"] for r in metrics.confusion_matrix(golden, "label", "pred").collect()}
    assert cells == {(0, 0): 1824, (0, 1): 121, (1, 0): 41, (1, 1): 108}
    one = spark.createDataFrame([(1, 1)], "label int, pred int")
    assert [r["n"] for r in metrics.confusion_matrix(one, "label", "pred").collect()] == [0, 0, 0, 1]


def test_scores_without_positives_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, pred int")
    got = metrics.binary_scores(df, "label", "pred").first()
    assert (got["precision"], got["recall"], got["f1"], got["tn"]) == (0.0, 0.0, 0.0, 2)


def test_classification_report(golden):
    lines = {r["label"]: r for r in metrics.classification_report(golden, "label", "pred").collect()}
    p0, r0 = 1824 / 1865, 1824 / 1945
    assert lines["negative"]["precision"] == pytest.approx(p0)
    assert lines["negative"]["recall"] == pytest.approx(r0)
    assert lines["negative"]["support"] == 1945 and lines["positive"]["support"] == 149
    assert lines["accuracy"]["f1"] == pytest.approx(1932 / 2094)
    f0 = 2 * p0 * r0 / (p0 + r0)
    assert lines["macro avg"]["f1"] == pytest.approx((f0 + 216 / 378) / 2)
    assert lines["weighted avg"]["f1"] == pytest.approx((f0 * 1945 + 216 / 378 * 149) / 2094)


def test_multilabel_against_brute_force(spark):
    rng = random.Random(4)
    rows = [([rng.randint(0, 1) for _ in range(6)] + [0], [rng.randint(0, 1) for _ in range(6)] + [0]) for _ in range(300)]
    df = spark.createDataFrame(rows, "gold array<int>, pred array<int>")
    got = {r["label"]: r for r in metrics.multilabel_scores(df, "gold", "pred").collect()}
    f1s = []
    for i, name in enumerate(VECTOR_NAMES):
        tp = sum(g[i] and p[i] for g, p in rows)
        fp = sum(p[i] and not g[i] for g, p in rows)
        fn = sum(g[i] and not p[i] for g, p in rows)
        f1s.append(2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0)
        assert (got[name]["tp"], got[name]["fp"], got[name]["fn"], got[name]["f1"]) == (tp, fp, fn, f1s[-1])
        assert sum(got[name][c] for c in ("tp", "fp", "fn", "tn")) == 300
    assert f1s[-1] == 0.0
    assert got["avg"]["f1"] == pytest.approx(sum(f1s) / 7)


def test_group_metrics(spark):
    rows = [("a", 1, 1), ("a", 0, 1), ("a", 1, 0), ("b", 0, 0), ("b", 0, 0), (None, 1, 1), ("c", 1, 1)]
    df = spark.createDataFrame(rows, "k string, label int, pred int")
    got = [tuple(r) for r in metrics.group_metrics(df, "k", "label", "pred").collect()]
    # overall: tp 3, fp 1, fn 1 -> 0.75
    assert got == [
        ("b", 2, 0, 0.0, 0.0, 0.0, 0.0, True),
        ("a", 3, 2, 66.7, 0.5, 0.5, 0.5, True),
        ("c", 1, 1, 100.0, 1.0, 1.0, 1.0, False),
    ]


def test_group_counts_do_not_depend_on_partitions(golden):
    keyed = golden.withColumn("k", F.when(F.col("row_no") % 3 == 0, "hot").otherwise(F.col("row_no").cast("string")))
    one = metrics.group_metrics(keyed.coalesce(1), "k", "label", "pred").collect()
    many = metrics.group_metrics(keyed.repartition(9, "pred"), "k", "label", "pred").collect()
    assert one == many
    assert sum(r["total"] for r in one) == 2094


def test_length_bins(spark):
    rows = [(0, 1, 1), (1, 1, 0), (20, 0, 1), (21, 1, 1), (1000, 1, 0), (1000, 1, 1), (1001, 0, 0), (None, 1, 1)]
    df = spark.createDataFrame(rows, "n int, label int, pred int")
    got = [tuple(r) for r in metrics.length_bin_errors(df, "n", "label", "pred").collect()]
    assert got == [
        (0, "0-20", 2, 1, 1.0, 1.0),
        (1, "21-40", 1, 1, 0.0, None),
        (6, "200+", 2, 2, 0.5, None),
    ]


def test_error_listings(spark):
    rows = [(i, f"k{i % 3}" if i % 7 else None, i % 2, (i // 2) % 2, "x" * 300) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, k string, label int, pred int, text string")
    totals = errors.error_totals(df, "label", "pred").first()
    assert tuple(totals) == (50, 50)
    breakdown = errors.error_breakdown(df, "k", "label", "pred").collect()
    expected = {}
    for _, k, g, p, _ in rows:
        if g != p and k:
            expected[("FP" if p else "FN", k)] = expected.get(("FP" if p else "FN", k), 0) + 1
    assert {(r["err_type"], r["k"]): r["n"] for r in breakdown} == expected
    order = [(r["err_type"], -r["n"], r["k"]) for r in breakdown]
    assert order == sorted(order)
    one = errors.error_sample(df.coalesce(1), "id", "label", "pred", "text", ["k"], n=8).collect()
    many = errors.error_sample(df.repartition(6), "id", "label", "pred", "text", ["k"], n=8).collect()
    assert one == many and len(one) == 16
    assert all(len(r["snippet"]) == 200 for r in one)
    assert len(errors.error_sample(df, "id", "label", "pred", "text", n=1000).collect()) == 100


def test_large_samples_take_the_bucketed_way(spark, conf):
    rows = [(i, i % 2, 1 - i % 2, "t") for i in range(300)]
    df = spark.createDataFrame(rows, "id int, label int, pred int, text string")
    plain = errors.error_sample(df, "id", "label", "pred", "text", n=40).collect()
    conf("spark.sql.optimizer.windowGroupLimitThreshold", "10")
    assert errors.error_sample(df, "id", "label", "pred", "text", n=40).collect() == plain


def test_loss_against_a_formula(spark):
    import math

    rows = [(0.9, 1), (0.2, 1), (0.3, 0)]
    df = spark.createDataFrame(rows, "prob double, label int")
    weights = splits.class_weights(df, "label")
    total = 0.0
    for prob, y in rows:
        p = prob if y else 1 - prob
        alpha = 3 / (2 * (2 if y else 1))
        total += alpha * (1 - p) ** 2 * -(0.9 * math.log(p) + 0.1 * math.log(1 - p))
    got = metrics.dataset_loss(df, "prob", "label", weights).first()
    assert got["loss"] == pytest.approx(total / 3) and got["n"] == 3
    margins = df.withColumn("z", F.ln(F.col("prob") / (1 - F.col("prob"))))
    assert metrics.dataset_loss(margins, "z", "label", weights, log_odds=True).first()["loss"] == pytest.approx(total / 3)


def test_loss_of_saturated_probabilities(spark):
    weights = spark.createDataFrame([(0, 1.0), (1, 1.0)], "label int, weight double")
    for rows, least in (([(0.5, 1), (0.0, 1)], 300), ([(1.0, 1), (0.0, 0)], 0), ([(1.0, 0)], 600)):
        got = metrics.dataset_loss(spark.createDataFrame(rows, "prob double, label int"), "prob", "label", weights).first()
        assert got["n"] == len(rows) and least <= got["loss"] < 1000
    with pytest.raises(Exception, match="no loss"):
        metrics.dataset_loss(spark.createDataFrame([(None, 1)], "prob double, label int"), "prob", "label", weights).collect()


@pytest.mark.parametrize("row", [(None, 1), (1, None), (2, 1), (0, -1)])
def test_labels_other_than_0_and_1_raise(spark, row):
    df = spark.createDataFrame([(0, 1), row], "label int, pred int")
    for table in (metrics.binary_scores, metrics.classification_report, metrics.confusion_matrix):
        with pytest.raises(Exception, match="must be 0 or 1"):
            table(df, "label", "pred").collect()
