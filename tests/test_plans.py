"""Shapes of physical plans."""

import re

import pytest
from pyspark.sql import functions as F

from labelgrain.operators import splits
from labelgrain.plans import table_queries as Q

TABLES = "/root/testdata/sf0.001"
EAGER = {"classifier_scores", "trial_log", "classifier_checks", "trial_checks", "epoch_log", "epoch_checks", "focal_gradient"}


def plan(df, executed=False):
    if executed:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - EAGER))
def test_no_python_and_no_cross_product(spark, name):
    text = plan(Q.QUERIES[name](spark, TABLES))
    for node in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "RoundRobin"):
        assert node not in text, node


@pytest.mark.parametrize(
    "name", ["keyword_metrics", "length_bin_errors", "error_breakdown", "top_ngrams", "token_stats", "category_lists"]
)
def test_single_partition_only_after_aggregation(spark, name):
    """Reading bottom-up, rows are combined before anything meets in one task."""
    text = plan(Q.QUERIES[name](spark, TABLES))
    for i, line in enumerate(lines := text.splitlines()):
        if "SinglePartition" in line:
            assert any("Aggregate" in below for below in lines[i + 1 : i + 6])


def test_metrics_read_no_text(spark):
    text = plan(Q.keyword_metrics(spark, TABLES))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and not any("text" in s for s in schemas)


@pytest.mark.parametrize("name", ["keyword_metrics", "class_distribution"])
def test_scalar_totals_share_the_shuffle(spark, name):
    text = plan(Q.QUERIES[name](spark, TABLES), executed=True)
    assert "ReusedExchange" in text or "ReusedQueryStage" in text or text.count("ResultQueryStage") >= 1
    final = text.split("== Initial Plan ==")[0]
    assert "Reused" in final


def test_top_ngrams_prune_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(Q.top_ngrams(spark, TABLES))


def test_ngram_counting_hashes(spark):
    text = plan(Q.top_word_ngrams(spark, TABLES))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text


def test_category_lists_shuffle_once(spark):
    text = plan(Q.category_lists(spark, TABLES))
    assert text.count("Exchange hashpartitioning") == 1


def test_semi_join_has_no_forced_broadcast(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    big = spark.range(10).withColumn("k", F.col("id"))
    assert "Broadcast" not in plan(splits.keep_split(big, big.select("k"), "k"))
    assert "Broadcast" not in plan(splits.attach_in_order(big.withColumn("row_no", F.col("id")), big, "k"))


def test_attaching_stores_keys_alone(spark, tmp_path, monkeypatch):
    """What is stored has no text; found rows come from an inner join, and a length of the text is all that is joined."""
    path = str(tmp_path / "corpus")
    spark.createDataFrame([("1", "t"), ("2", "u")], "k string, text string").write.parquet(path)
    corpus = spark.read.parquet(path)
    ids = spark.createDataFrame([(0, "2"), (1, "9")], "row_no int, k string")
    seen = []
    store = splits.stored
    monkeypatch.setattr(splits, "stored", lambda df: seen.append(df) or store(df))
    attached = splits.attach_in_order(ids, corpus, "k")
    assert [df.columns for df in seen] == [["k"]] and "text" not in plan(seen[0])
    rest = plan(attached)
    assert "Inner" in rest and "LeftAnti" in rest and "LeftOuter" not in rest
    assert "text" not in plan(attached.select("row_no"))
    assert sorted(tuple(r) for r in attached.select("row_no", "text").collect()) == [(0, "u"), (1, None)]


def test_texts_are_tokenised_once(spark):
    """What learns and scores starts from stored term counts, not from texts."""
    from labelgrain.operators import classify

    terms = classify.term_vectors(spark.createDataFrame([("a b", 0), ("c", 1)], "text string, label int"), "text")
    weights = splits.class_weights(terms, "label")
    model = classify.fit_classifier(terms, "text", "label", weights, classify.Params(features=16))
    assert "split" not in plan(classify.score(model, terms)) and "text" not in terms.columns
