import pytest
from pyspark.sql import functions as F

from labelgrain.operators import splits


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(0, "a", "text a"), (1, "b", "text b"), (2, "b", "text b again"), (3, "c", "text c"), (4, "x", "text x")]
    return spark.createDataFrame(rows, "row_no bigint, par_id string, text string")


@pytest.fixture(scope="module")
def ids(spark):
    rows = [(0, "c"), (1, "b"), (2, "missing"), (3, "c")]
    return spark.createDataFrame(rows, "row_no bigint, par_id string")


def test_keep_split_ignores_repeated_ids(corpus, ids):
    kept = splits.keep_split(corpus, ids, "par_id").orderBy("row_no").collect()
    assert [r["text"] for r in kept] == ["text b", "text b again", "text c"]


def test_attach_keeps_list_order_and_multiplies(corpus, ids):
    joined = splits.attach_in_order(ids, corpus, "par_id")
    got = [(r["row_no"], r["text"]) for r in joined.orderBy("row_no", "text").collect()]
    assert got == [(0, "text c"), (1, "text b"), (1, "text b again"), (2, None), (3, "text c")]
    dense = splits.attach_in_order(ids, corpus, "par_id", renumber=True)
    got = [(r["row_no"], r["text"]) for r in dense.orderBy("row_no").collect()]
    assert got == [(0, "text c"), (1, "text b"), (2, "text b again"), (3, None), (4, "text c")]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_with_row_no_is_dense(spark, parts):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(parts)
    got = splits.with_row_no(df, ["v"]).orderBy("row_no").collect()
    assert [(r["row_no"], r["v"]) for r in got] == [(i, i) for i in range(1000)]


def test_replace_label(spark):
    df = spark.createDataFrame([(1, 0)], "label int, vote int")
    assert splits.replace_label(df, "label", "vote").collect()[0].asDict() == {"label": 0}


def series(spark, n, name):
    return spark.range(n).select(F.col("id").alias("row_no"), (F.col("id") % 2).cast("int").alias(name))


def test_align(spark):
    gold = series(spark, 10, "label")
    assert splits.align(gold, series(spark, 10, "pred")).where("label = pred").count() == 10
    for n in (9, 11):
        with pytest.raises(Exception, match="differ in length"):
            splits.align(gold, series(spark, n, "pred")).count()
    assert splits.align(gold, series(spark, 11, "pred"), extra="ignore").count() == 10
    with pytest.raises(Exception, match="differ in length"):
        splits.align(gold, series(spark, 9, "pred"), extra="ignore").agg(F.sum("label")).collect()
    with pytest.raises(ValueError):
        splits.align(gold, gold, extra="other")


def test_split_summary(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (None,)], "label int")
    assert tuple(splits.split_summary(df, "label").first()) == (4, 1, pytest.approx(100 / 3))
    assert tuple(splits.split_summary(df.limit(0), "label").first()) == (0, 0, 0.0)


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "label int")
    got = [tuple(r) for r in splits.class_weights(df, "label").orderBy("label").collect()]
    assert got == [(0, 3, pytest.approx(4 / 6)), (1, 1, 2.0)]
    gap = spark.createDataFrame([(0,), (2,)], "label int")
    got = [tuple(r) for r in splits.class_weights(gap, "label").orderBy("label").collect()]
    assert got == [(0, 1, pytest.approx(2 / 3)), (1, 0, None), (2, 1, pytest.approx(2 / 3))]
    for bad in (-1, None):
        with pytest.raises(Exception, match="class labels must be"):
            splits.class_weights(spark.createDataFrame([(bad,), (1,)], "label int"), "label").collect()
