"""Training on the focal loss, epoch by epoch, against plain numbers."""

import math
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from labelgrain.functions import numbers as N
from labelgrain.operators import focal
from labelgrain.plans import train_predict
from labelgrain.sources import sinks

SMALL = focal.Settings(features=64, epochs=4, reg=0.0)


def docs(seed=1, n=120):
    """Texts whose label follows one word, and noise."""
    rnd = random.Random(seed)
    made = []
    for i in range(n):
        words = [f"w{rnd.randrange(30)}" for _ in range(rnd.randint(0, 12))]
        label = int(rnd.random() < 0.3)
        if rnd.random() < 0.9:
            words.insert(rnd.randint(0, len(words)), "Bad" if label else "good")
        made.append((i, " ".join(words) if rnd.random() < 0.95 else None, label))
    return made


@pytest.fixture(scope="module")
def parts(spark):
    df = spark.createDataFrame(docs(), "row_no bigint, text string, label int")
    return df.where("row_no % 3 > 0"), df.where("row_no % 3 = 0")


def plain_loss(rows, weights, gamma=2.0, smoothing=0.1):
    """``rows``: (feature list, label, alpha)."""
    total = 0.0
    for words, label, alpha in rows:
        m = weights[-1] + sum(weights[w] for w in words) / max(1, len(words))
        p = 1 / (1 + math.exp(-m if label else m))
        total += alpha * (1 - p) ** gamma * -((1 - smoothing) * math.log(p) + smoothing * math.log(1 - p))
    return total / len(rows)


@pytest.mark.parametrize(("gamma", "smoothing"), [(2.0, 0.1), (0.0, 0.0), (1.5, 0.3)])
def test_gradient_against_differences(spark, gamma, smoothing):
    rnd = random.Random(3)
    rows = [([rnd.randrange(6) for _ in range(rnd.randint(0, 5))], rnd.randint(0, 1), rnd.choice([0.5, 2.0])) for _ in range(50)]
    settings = focal.Settings(features=6, gamma=gamma, smoothing=smoothing)
    df = spark.createDataFrame(rows, "_words array<int>, label int, _alpha double").repartition(3)
    weights = np.array([rnd.gauss(0, 2) for _ in range(7)])
    loss, gradient = focal.loss_and_gradient(df, "label", weights, settings)
    assert loss == pytest.approx(plain_loss(rows, weights, gamma, smoothing), rel=1e-12)
    for k in range(7):
        step = np.zeros(7)
        step[k] = 1e-5
        up, down = (plain_loss(rows, weights + s, gamma, smoothing) for s in (step, -step))
        assert gradient[k] == pytest.approx((up - down) / 2e-5, abs=1e-8)


def test_terms_are_those_of_the_expression(spark):
    pairs = [(m, y, a) for m in (-800.0, -40.0, -1.0, 0.0, 0.3, 40.0, 800.0) for y in (0, 1) for a in (0.5, 3.0)]
    rows = spark.createDataFrame(pairs, "m double, y int, a double")
    expected = [r[0] for r in rows.select(N.focal_loss(F.col("m"), F.col("y"), F.col("a"))).collect()]
    m, y, a = map(np.array, zip(*pairs))
    loss, slope = focal.focal_terms(m, y, a, 2.0, 0.1)
    assert loss == pytest.approx(expected, rel=1e-12) and np.isfinite(slope).all()
    # far on the wrong side the loss grows by what smoothing leaves
    assert slope[(m == 800) & (y == 0)] == pytest.approx([0.45, 2.7]) and slope[(m == -800) & (y == 1)] == pytest.approx([-0.45, -2.7])


def test_direction_solves_a_quadratic():
    """After as many steps as dimensions L-BFGS knows the curvature."""
    rng = np.random.default_rng(2)
    a = rng.standard_normal((4, 4))
    a = a @ a.T + np.eye(4)
    steps = [(s, a @ s) for s in np.eye(4)]
    steps += [(s, a @ s) for s in rng.standard_normal((40, 4))]
    g = rng.standard_normal(4)
    assert focal.direction(g, steps) == pytest.approx(-np.linalg.solve(a, g), rel=1e-3)
    assert focal.direction(g, []).tolist() == (-g).tolist()
    assert focal.direction(g, [(g, -g)]).tolist() == (-g).tolist()


def test_epochs_by_value(spark, parts, tmp_path):
    """Each logged figure from the stored weights and the texts."""
    train, dev = parts
    model, log = focal.train_epochs(train, dev, SMALL, state_dir=str(tmp_path))
    rows = log.orderBy("epoch").collect()
    assert [r.epoch for r in rows] == [1, 2, 3, 4]
    losses = [r.train_loss for r in rows]
    assert all(a > b for a, b in zip(losses, losses[1:]))
    trainer = focal.Trainer(train, "text", "label", SMALL)
    sample = [(r._words, r.label, r._alpha) for r in trainer.rows.collect()]
    judged = [(r._words, r.label) for r in focal.word_features(dev, "text", SMALL).collect()]
    frequencies = [math.log((len(sample) + 1) / (sum(f in set(w) for w, _, _ in sample) + 1)) for f in range(64)]
    assert trainer.idf == pytest.approx(frequencies)

    def f1(threshold, probs):
        hits = [(np.float32(p) >= np.float32(threshold), y) for p, y in probs]
        tp, fp, fn = (sum(1 for h, y in hits if (h, y) == pair) for pair in ((True, 1), (True, 0), (False, 1)))
        return 2 * tp / (2 * tp + fp + fn) if tp else 0.0

    grid = [0.1 + i * ((0.1 + 0.01) - 0.1) for i in range(80)]
    for r in rows:
        weights = focal.read_state(spark, str(tmp_path), r.epoch, 64)[0] * trainer.scale
        assert r.train_loss == pytest.approx(plain_loss(sample, weights), rel=1e-9)
        probs = [(1 / (1 + math.exp(-(weights[-1] + sum(weights[w] for w in words) / max(1, len(words))))), y) for words, y in judged]
        assert r.dev_f1_05 == pytest.approx(f1(0.5, probs))
        best = max((f1(t, probs), -t) for t in grid)
        assert (r.best_tuned_f1, r.threshold) == (pytest.approx(best[0]), pytest.approx(-best[1]))
    best = max(rows, key=lambda r: (r.best_tuned_f1, -r.epoch)).epoch
    assert model.weights == pytest.approx(focal.read_state(spark, str(tmp_path), best, 64)[0] * trainer.scale)


def test_a_killed_job_goes_on(spark, parts, tmp_path, monkeypatch):
    train, dev = parts
    whole = focal.train_epochs(train, dev, SMALL)[1].orderBy("epoch").collect()
    path, state = str(tmp_path / "log"), str(tmp_path / "state")

    def run(fail_at=None):
        def keep(row):
            if row.first()["epoch"] == fail_at:
                raise RuntimeError("killed")
            sinks.record_metrics(row, path)

        logged = sinks.recorded_metrics(spark, path, focal.LOG_SCHEMA)
        return focal.train_epochs(train, dev, SMALL, state_dir=state, logged=logged, after_epoch=keep)

    with pytest.raises(RuntimeError, match="killed"):
        run(fail_at=3)
    steps = []
    plain = focal.Trainer.step
    monkeypatch.setattr(focal.Trainer, "step", lambda *a: steps.append(1) or plain(*a))
    model, log = run()
    assert len(steps) == 2
    for a, b in zip(whole, log.orderBy("epoch").collect(), strict=True):
        assert tuple(a) == pytest.approx(tuple(b), rel=1e-6)
    stored = sinks.recorded_metrics(spark, path, focal.LOG_SCHEMA)
    assert sorted(r.epoch for r in stored.collect()) == [1, 2, 3, 4]
    assert len(steps) == 2 and run()[1].count() == 4 and len(steps) == 2


def test_known_decisions(spark, tmp_path):
    """A separable corpus is decided right, by the model and by what is written of it."""
    rows = [(i, f"{'awful' if i % 4 == 0 else 'plain'} words of text {i % 7}", int(i % 4 == 0)) for i in range(80)]
    df = spark.createDataFrame(rows, "row_no bigint, text string, label int")
    model, log = train_predict.train_by_epoch(spark, df, df, df.drop("label"), str(tmp_path), focal.Settings(features=1 << 12, epochs=5))
    assert log.agg(F.max("best_tuned_f1")).first()[0] == 1.0
    assert [int(r.value) for r in spark.read.text(str(tmp_path / "test.txt")).collect()] == [y for _, _, y in rows]
    back = focal.read_model(spark, str(tmp_path / "model"))
    assert back.settings == model.settings and back.weights == pytest.approx(model.weights)
    again = focal.predict(back, df, 0.5, "text")
    assert again.columns == ["row_no", "text", "label", "prob", "pred"]
    again, first = train_predict.train_by_epoch(spark, df, df, df.drop("label"), str(tmp_path), focal.Settings(features=1 << 12, epochs=5))
    assert again.weights == pytest.approx(model.weights) and first.count() == 5


def test_odd_rows(spark):
    settings = focal.Settings(features=16, epochs=1, max_tokens=2, min_doc_freq=2)
    df = spark.createDataFrame([("a b c", 1), (None, 0), ("", 0), ("b x", 1)], "text string, label int")
    words = [r._words for r in focal.word_features(df, "text", settings).collect()]
    assert [len(w) for w in words] == [2, 0, 0, 2] and words[0][1] == words[3][0]
    model, log = focal.train_epochs(df, df, settings)
    assert log.count() == 1 and all(math.isfinite(x) for x in model.weights)
    with pytest.raises(Exception, match="no class weight"):
        focal.train_epochs(df.withColumn("label", F.lit(2)), df, settings)
    none = focal.train_epochs(df.limit(0), df, settings)[0]
    assert not none.weights.any() and {r.prob for r in focal.score(none, df, "text").collect()} == {0.5}


def test_chunks_are_every_row_and_bounded():
    """Empty, null and very long rows in one batch, and in a slice of it."""
    lists = [[1] * 5, [], None, [0] * (focal.CHUNK_WORDS + 7), [2, 3], [3] * 4, []]
    weights = np.array([1.0, 2.0, 4.0, 8.0, 0.5])
    plain = [0.5 + (sum(weights[w] for w in x) / len(x) if x else 0.0) for x in lists]
    column = pa.array(lists, pa.list_(pa.int32()))
    for first in (0, 1, 3, 7):
        assert focal.margins_of(column.slice(first), weights) == pytest.approx(plain[first:])
    chunks = list(focal.word_chunks(column))
    assert [at for at, _ in chunks] == [0, 3, 4] and sum(len(c) for _, c in chunks) == len(lists)


def test_memory_of_log_odds_does_not_follow_the_batch():
    column = pa.array(np.arange(3_000_000) % 256, pa.int32())
    column = pa.ListArray.from_arrays(pa.array(np.arange(0, 3_000_001, 300), pa.int32()), column)
    tracemalloc.start()
    focal.margins_of(column, np.ones(257))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6


def test_texts_do_not_go_to_python(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id int, text string")
    scored = focal.predict(focal.Model(np.ones(17), focal.Settings(features=16)), df, 0.5, "text")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" in plan
    assert scored.columns == ["doc_id", "text", "prob", "pred"]
