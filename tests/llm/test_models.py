"""Language identification and the quality classifier on held-out rows."""

import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from labelgrain.llm.co_training import Params, combination, fact_feature, page_features, quality_scores, views
from labelgrain.llm.language_id import bundled, fit_profiles, identify_languages, keep_identified, trigram_vectors, trigrams

from corpus import frame

TABLES = "/root/testdata/sf0.01"


def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    found = identify_languages(docs)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    both = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in both if r.held_out]
    assert len(both) == docs.count() and 200 < len(held) < 500
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in both)


def test_trigrams_have_letters_in_the_middle():
    owner, keys, letters = trigrams(["Ab, c", "", "12"])
    space, a, b, c = 0, ord("a"), ord("b"), ord("c")
    triples = [(space, a, b), (a, b, space), (space, c, space)]
    assert keys.tolist() == [x << 42 | y << 21 | z for x, y, z in triples]
    assert owner.tolist() == [0, 0, 0] and letters.tolist() == [3, 0, 0]


def test_languages_of_odd_rows(spark):
    rows = [(1, "the cat"), (2, None), (3, ""), (4, "123 !?"), (None, "the dog"), (4, "the end"), (6, "日本語")]
    found = sorted(((r[0] is None, r[0] or 0, r.lang_pred) for r in identify_languages(frame(spark, rows)).collect()))
    assert found == [(False, 1, "en"), (False, 2, "und"), (False, 3, "und"), (False, 4, "en"), (False, 4, "und"), (False, 6, "en"), (True, 0, "en")]
    kept = keep_identified(frame(spark, rows))
    assert kept.columns == frame(spark, rows).columns
    assert sorted(r.text for r in kept.collect()) == ["the cat", "the dog", "the end", "日本語"]
    assert identify_languages(frame(spark, [])).count() == 0
    unlearned = identify_languages(frame(spark, rows).selectExpr("doc_id", "text", "cast(null as string) as lang")).collect()
    assert {r.lang_pred for r in unlearned} == {"und"}


def test_profiles_are_unit_vectors(spark):
    profiles = fit_profiles(frame(spark, [(1, "some words"), (2, "more words")]))
    assert profiles.names == ["en"] and abs(float((profiles.vectors**2).sum()) - 1) < 1e-5


def test_a_long_text_of_many_letters(spark):
    """Two million different trigrams take a bounded number of vectors at a time."""
    rnd = np.random.default_rng(3)
    text = "".join(map(chr, rnd.integers(0x4E00, 0x9FFF, 2_000_000)))
    tracemalloc.start()
    sums, letters = bundled([text[:200_000], "abc"], np.array([0, 1]), 2, 1024)
    assert tracemalloc.get_traced_memory()[1] < 200e6
    tracemalloc.stop()
    owner, keys, _ = trigrams([text[:200_000], "abc"])
    assert letters.tolist() == [200_000, 3]
    whole = sum(trigram_vectors(keys[owner == 0][a : a + 5000], 1024).astype(int).sum(axis=0) for a in range(0, int((owner == 0).sum()), 5000))
    assert sums[0].tolist() == whole.tolist()
    rows = [(1, text), (2, "the cat and the dog"), (3, "der Hund und die Katze")]
    docs = spark.createDataFrame([(i, t, "zz" if i == 1 else "en" if i == 2 else "de") for i, t in rows], "doc_id bigint, text string, lang string")
    assert identify_languages(docs).count() == 3


def auc(pairs):
    good, bad = ([s for s, label in pairs if label == want] for want in (1, 0))
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def test_quality_held_out(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    train = labels.where("pmod(xxhash64(doc_id, 9), 3) > 0")
    scores = quality_scores(docs, train, Params(rounds=1))
    assert scores.count() == docs.count()
    rest = labels.join(train, "doc_id", "left_anti").where("toxic = 0").join(scores, "doc_id").collect()
    assert auc([(r.score, r.quality) for r in rest]) > 0.9


def test_quality_of_odd_rows(spark):
    rows = [(i, t) for i, t in enumerate(["good text here", "BAD!! BAD!!", None, ""] * 6)] + [(None, "x"), (1, "again")]
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(12)] + [(None, 1, 0), (3, None, 0), (4, 1, None)], "doc_id bigint, quality int, toxic int")
    scores = quality_scores(frame(spark, rows), labels, Params(rounds=1)).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores)
    none = quality_scores(frame(spark, rows), labels.where("quality = 7")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_scores(frame(spark, []), labels).count() == 0


def logistic(x, y, reg):
    """A ridge regression without a penalty on the bias, to the last digit, by Newton's method."""
    x = np.column_stack((x, np.ones(len(x))))
    w, pull = np.zeros(x.shape[1]), reg * np.append(np.ones(x.shape[1] - 1), 0)
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ w))
        h = (x * (p * (1 - p))[:, None]).T @ x / len(x) + np.diag(pull)
        w -= np.linalg.solve(h, x.T @ (p - y) / len(x) + pull * w)
    return w


def test_quality_equals_plain_co_training(spark):
    """Every score as by dense regressions on all documents that either view is sure of."""
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(220):
        good = rnd.random() < 0.6
        words = [rnd.choice("plan report meeting fine".split() if good != (rnd.random() < 0.1) else "junk spam click buy".split()) for _ in range(rnd.randint(1, 12))]
        rows.append((i, " ".join(words), rnd.choice(["en", None]), f"{rnd.choice('abc')}.{'good' if good != (rnd.random() < 0.15) else 'bad'}.example.com"))
        if i % 2:
            labels.append((i, int(good), int(rnd.random() < 0.05)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    params = Params(sure=0.75, reg=0.05, max_iter=400)
    found = {r.doc_id: r for r in quality_scores(docs, marks, params).collect()}

    made = list(views(pa.array([r[1] for r in rows]), [r[3] for r in rows], [r[2] for r in rows]))
    held_ids = {r.doc_id for r in marks.where("pmod(xxhash64(doc_id, 3), 4) = 0").collect()}
    label = {i: float(q == 1 and t == 0) for i, q, t in labels}
    target = np.array([label.get(i, np.nan) for i in range(len(rows))])
    held = np.array([i in held_ids for i in range(len(rows))])
    dense = []
    for k in (0, 1):
        used = sorted({f for m in made for f in m[k]})
        dense.append(np.array([[f in set(m[k]) for f in used] for m in made], dtype=float))
    z, pseudo = None, [np.full(len(rows), np.nan)] * 2
    for turn in range(params.rounds + 1):
        if z is not None:
            p = [1 / (1 + np.exp(-v)) for v in z]
            pseudo = [np.where(np.maximum(q, 1 - q) >= params.sure, np.round(q), np.nan) for q in p]
        z_new = []
        for k in (0, 1):
            y = np.where(held, np.nan, np.where(np.isnan(target), pseudo[1 - k], target))
            known = ~np.isnan(y)
            w = logistic(dense[k][known], y[known], params.reg)
            z_new.append(dense[k] @ w[:-1] + w[-1])
            assert turn == 0 or known.sum() > (~np.isnan(target) & ~held).sum() + 10
        z = z_new
    mixed = combination(np.column_stack(z)[held], target[held])
    for i in range(len(rows)):
        expected = [1 / (1 + math.exp(-v)) for v in (z[0][i], z[1][i], mixed @ [1, z[0][i], z[1][i]])]
        assert [found[i].text_score, found[i].page_score, found[i].score] == pytest.approx(expected, abs=1e-6)


def test_page_facts_are_hashed_whole():
    empty = np.empty(0, dtype=np.uint8)
    one, other = (page_features(f"{x}.example.com", "en", empty, 0) for x in "ab")
    assert len(set(one) ^ set(other)) == 2 and fact_feature("source a.example.com") in one


def test_quality_of_very_long_and_spaceless_texts(spark):
    rows = [(1, "word " * 400_000), (2, "\u65e5\u672c" * 500_000), (3, "x")] + [(i, "good plan" if i % 2 else "bad junk") for i in range(4, 60)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(4, 60)], "doc_id bigint, quality int, toxic int")
    scores = {r.doc_id: r.score for r in quality_scores(frame(spark, rows), labels).collect()}
    assert len(scores) == len(rows) and all((scores[i] > 0.5) == bool(i % 2) for i in range(4, 60))


@pytest.fixture(autouse=True)
def tables():
    import os

    if not os.path.isdir(TABLES):
        pytest.skip("no test tables")
