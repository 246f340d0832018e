import random
import statistics
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelgrain.operators import explore


def test_class_distribution_counts_unlabelled_rows_in_the_total(spark):
    df = spark.createDataFrame([(0,), (0,), (1,), (None,)], "label int")
    assert [tuple(r) for r in explore.class_distribution(df, "label").collect()] == [(0, 2, 50.0), (1, 1, 25.0)]
    assert [tuple(r) for r in explore.class_counts(df, "label").collect()] == [(0, 2), (1, 1)]


def test_preview(spark):
    df = spark.range(20).select(F.col("id").alias("row_no")).repartition(5)
    assert [r[0] for r in explore.preview(df).collect()] == [0, 1, 2, 3, 4]


def test_token_stats(spark):
    rng = random.Random(8)
    rows = [(rng.choice([0, 1, None]), rng.randint(0, 60)) for _ in range(500)] + [(1, None)]
    df = spark.createDataFrame(rows, "label int, n int")
    got = {r["scope"]: r for r in explore.token_stats(df.repartition(6), "n", "label").collect()}
    groups = {"overall": [n for _, n in rows if n is not None]}
    for label in (0, 1):
        groups[str(label)] = [n for y, n in rows if y == label and n is not None]
    assert set(got) == set(groups)
    for scope, numbers in groups.items():
        r = got[scope]
        assert (r["n"], r["max"]) == (len(numbers), max(numbers))
        assert r["mean"] == pytest.approx(statistics.mean(numbers))
        assert r["percentile"] == pytest.approx(np.quantile(numbers, 0.95))
    rough = {r["scope"]: r for r in explore.token_stats(df, "n", "label", exact=False).collect()}
    assert set(rough) == set(groups)
    for scope, numbers in groups.items():
        r = rough[scope]
        assert (r["n"], r["max"]) == (len(numbers), max(numbers))
        assert r["mean"] == pytest.approx(statistics.mean(numbers))
        assert r["percentile"] in numbers and abs(r["percentile"] - np.quantile(numbers, 0.95)) <= 2


@pytest.mark.parametrize("bins", [1, 7, 50])
def test_histogram_equals_numpy(spark, bins):
    rng = random.Random(9)
    rows = [("a", float(rng.randint(3, 203))) for _ in range(2000)] + [("b", rng.gauss(0, 1)) for _ in range(500)] + [("c", 5.0)] * 3
    df = spark.createDataFrame(rows, "k string, v double")
    got = explore.histogram(df, "v", "k", bins).orderBy("k", "bin").collect()
    for k in "abc":
        counts, edges = np.histogram([v for c, v in rows if c == k], bins=bins)
        mine = [r for r in got if r["k"] == k]
        assert [r["n"] for r in mine] == list(counts)
        assert [r["bin_from"] for r in mine] == pytest.approx(list(edges[:-1]))
        assert [r["bin_to"] for r in mine] == pytest.approx(list(edges[1:]))


def test_top_ngrams_rank_ties_by_first_appearance(spark):
    rows = [(0, "b a c d", 0), (1, "c d b a x y", 0), (2, "only one class", 1), (3, None, 1)]
    df = spark.createDataFrame(rows, "row_no bigint, text string, label int")
    top = explore.top_ngrams(df.repartition(4), "text", "label", k=4, stop_words=(), order_col="row_no")
    got = [(r["label"], r["rank"], r["ngram"], r["n"]) for r in top.orderBy("label", "rank").collect()]
    assert got == [
        (0, 1, "b a", 2), (0, 2, "c d", 2), (0, 3, "a c", 1), (0, 4, "d b", 1),
        (1, 1, "only one", 1), (1, 2, "one class", 1),
    ]
    alphabetical = explore.top_ngrams(df, "text", "label", k=3, stop_words=())
    assert [r["ngram"] for r in alphabetical.where("label = 0").orderBy("rank").collect()] == ["b a", "c d", "a c"]


def test_top_ngrams_against_a_counter(spark, conf):
    rng = random.Random(10)
    words = ["river", "hill", "the", "sun", "and", "moon"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12))), i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, "row_no bigint, text string, label int")
    for k, threshold in ((3, "1000"), (8, "5")):
        conf("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
        top = explore.top_ngrams(df, "text", "label", k=k, tokeniser="letters", order_col="row_no").collect()
        for label in (0, 1):
            counter = Counter()
            for _, text, y in rows:
                if y == label:
                    kept = [w for w in text.split() if w not in ("the", "and")]
                    counter.update(zip(kept, kept[1:]))
            expected = [(" ".join(g), n) for g, n in counter.most_common(k)]
            got = sorted((r["rank"], r["ngram"], r["n"]) for r in top if r["label"] == label)
            assert [(g, n) for _, g, n in got] == expected


def test_unknown_tokeniser(spark):
    with pytest.raises(ValueError):
        explore.top_ngrams(spark.createDataFrame([("a", 1)], "t string, c int"), "t", "c", tokeniser="other")


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_percentile_in_rounds_equals_numpy(spark, q):
    rng = random.Random(11)
    rows = [("a", rng.gauss(0, 1e6)) for _ in range(301)] + [("b", float(rng.randint(0, 9))) for _ in range(200)] + [("c", 7.5)]
    rows += [("d", v) for v in (-1.7e308, 1.7e308, 5e-324, 0.0, 1e-323, 1.0, 1.0000000000000002)] + [(None, 3.0), (None, 4.0)]
    odd = [("a", None), ("b", float("nan")), ("b", float("inf")), ("e", None)]
    df = spark.createDataFrame(rows + odd, "k string, v double").repartition(4)
    got = {r.k: (r.n, r.percentile) for r in explore.exact_percentile(df, "v", q, "k", ranges=8).collect()}
    groups = {k: [v for c, v in rows if c == k] for k in {c for c, _ in rows}}
    assert set(got) == set(groups)
    for k, numbers in groups.items():
        place = (len(numbers) - 1) * q
        low, high = sorted(numbers)[int(place)], sorted(numbers)[-int(-place // 1)]
        assert got[k] == (len(numbers), pytest.approx(low + (place - int(place)) * (high - low)))
    whole = explore.exact_percentile(df.where("k = 'a'"), "v", q).collect()
    assert [r.percentile for r in whole] == [pytest.approx(float(np.quantile(groups["a"], q)))]
    assert explore.exact_percentile(df.limit(0), "v", q).count() == 0


def test_token_stats_in_rounds(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([(rng.choice([0, 1, None]), rng.choice([None, rng.randint(0, 10**6)])) for _ in range(300)], "label int, n int")
    both = [sorted(map(tuple, explore.token_stats(df, "n", "label", in_rounds=r).collect())) for r in (False, True)]
    assert [x[:4] for x in both[0]] == [x[:4] for x in both[1]]
    assert [x[4] for x in both[0]] == pytest.approx([x[4] for x in both[1]])


@pytest.mark.parametrize("counters", [1, 16, 1 << 17])
def test_frequent_ngrams_are_all_that_count(spark, counters):
    """The result is that of counting everything, with any number of counters."""
    rng = random.Random(12)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "xyz"]
    weights = [1 / (i + 1) ** 1.5 for i in range(len(words))]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randint(0, 30))), rng.choice([0, 1, None])) for i in range(300)]
    rows += [(900, "one two", 2), (901, None, 3)]
    df = spark.createDataFrame(rows, "row_no bigint, text string, label int")

    def top(**options):
        found = explore.top_ngrams(df, "text", "label", k=5, tokeniser="letters", stop_words=(), **options)
        return sorted(map(tuple, found.collect()), key=repr)

    assert top(counters=counters) == top()
    assert top(counters=counters, order_col="row_no") == top(order_col="row_no")


def test_frequent_ngrams_shuffle_few_rows(spark):
    """Of many rare n-grams hardly any is counted one by one."""
    rng = random.Random(13)
    grams = [(0, f"rare {rng.random()}") for _ in range(20_000)] + [(0, f"often {i}") for i in range(20) for _ in range(200 + i)]
    df = spark.createDataFrame(grams, "class int, ngram string")
    kept = explore.frequent_ngrams(df, 5, 1 << 12)
    assert kept.select("ngram").distinct().count() < 200
    counts = {r.ngram: r["count"] for r in kept.groupBy("ngram").count().collect()}
    assert [counts[f"often {i}"] for i in range(15, 20)] == [200 + i for i in range(15, 20)]
