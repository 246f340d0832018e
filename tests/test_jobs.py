"""The end-to-end jobs on small files of our own."""

import base64
import hashlib
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from labelgrain.operators import classify, splits
from labelgrain.plans import corpus_report, error_report, score_files, table_queries, train_predict

HEADER = "a\nb\nc\nd\n"
GOOD, BAD = "plain report of the meeting and the plan", "those poor helpless souls need our pity"


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)
    return str(folder / name)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    """60 paragraphs, 40 for training, 20 in a shuffled dev list."""
    folder = tmp_path_factory.mktemp("corpus")
    rng = random.Random(11)
    rows = [(f"{i:03d}", i % 3 == 0) for i in range(60)]
    body = "".join(
        f"{p}\ta{p}\tkw{int(p) % 4}\tgb\t{(BAD if y else GOOD)} {rng.choice('xyz')}\t{rng.choice('34') if y else rng.choice('01')}\n"
        for p, y in rows
    )
    dev = rows[40:]
    rng.shuffle(dev)
    votes = {True: '"[1, 1, 0]"', False: '"[0, 1, 0]"'}
    test = "".join(f"t_{i}\ta\tkw\tgb\t{BAD if i % 2 else GOOD}\n" for i in range(10))
    return {
        "dev": dev,
        "corpus": put(folder, "corpus.tsv", HEADER + body),
        "train_ids": put(folder, "train.csv", "par_id,label\n" + "".join(f'{p},"[0]"\n' for p, _ in rows[:40])),
        "dev_ids": put(folder, "dev.csv", "par_id,label\n" + "".join(f"{p},{votes[y]}\n" for p, y in dev)),
        "test": put(folder, "test.tsv", test),
    }


def test_score_submission_writes_the_published_lines(spark, tmp_path):
    rng = random.Random(12)
    pairs = [(1, 1)] * 108 + [(0, 1)] * 121 + [(1, 0)] * 41 + [(0, 0)] * 1824
    rng.shuffle(pairs)
    put(tmp_path / "ref", "task1.txt", "".join(f"{g}\n" for g, _ in pairs))
    put(tmp_path / "res", "task1.txt", "".join(f"{p}\n" for _, p in pairs))
    out = str(tmp_path / "scores")
    score_files.score_submission(spark, str(tmp_path / "ref"), str(tmp_path / "res"), out)
    lines = [r["value"] for r in spark.read.text(out).collect()]
    assert lines == [
        "task1_precision:0.47161572052401746", "task1_recall:0.7248322147651006", "task1_f1:0.5714285714285714",
    ]


def test_both_tasks_and_length_rules(spark, tmp_path):
    put(tmp_path / "ref", "task1.txt", "1\n0\n")
    put(tmp_path / "res", "task1.txt", "1\n1\n")
    put(tmp_path / "ref", "task2.txt", "1,0,0,0,0,0,0\n0,1,0,0,0,0,0\n")
    put(tmp_path / "res", "task2.txt", "1,0,0,0,0,0,0\n0,1,1,0,0,0,0\n1,1,1,1,1,1,1\n")
    scores = score_files.score_submission(spark, str(tmp_path / "ref"), str(tmp_path / "res"))
    got = [(r["name"], r["value"]) for r in scores.orderBy("line").collect()]
    assert [n for n, _ in got] == [
        "task1_precision", "task1_recall", "task1_f1", "task2_unb", "task2_sha", "task2_pre", "task2_aut",
        "task2_met", "task2_com", "task2_the", "task2_avg",
    ]
    assert [v for _, v in got[:3]] == [0.5, 1.0, 2 / 3]
    assert [v for _, v in got[3:]] == [1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, pytest.approx(2 / 7)]
    put(tmp_path / "res", "task2.txt", "1,0,0,0,0,0,0\n")
    with pytest.raises(Exception, match="differ in length"):
        score_files.score_submission(spark, str(tmp_path / "ref"), str(tmp_path / "res")).collect()
    put(tmp_path / "empty", "other.txt", "")
    assert score_files.score_submission(spark, str(tmp_path / "ref"), str(tmp_path / "empty")).count() == 0


def test_train_predict_and_analyse(spark, files, tmp_path):
    train, dev, test = train_predict.load_splits(spark, files["corpus"], files["train_ids"], files["dev_ids"], files["test"])
    assert [r["row_no"] for r in train.orderBy("row_no").collect()] == list(range(40))
    assert [(r["par_id"], r["label"] == 1) for r in dev.orderBy("row_no").collect()] == files["dev"]
    params = [classify.Params(features=256, max_iter=5, min_doc_freq=0, reg=r) for r in (0.01, 0.5)]
    out = str(tmp_path)
    model, log = train_predict.train_and_predict(spark, train, dev, test, out, params)
    assert [r["epoch"] for r in log.orderBy("epoch").collect()] == [1, 2]
    assert log.orderBy("epoch").first()["best_tuned_f1"] == 1.0
    assert spark.read.parquet(f"{out}/training_metrics").count() == 2
    preds = [int(r["value"]) for r in spark.read.text(f"{out}/test.txt").collect()]
    assert preds == [i % 2 for i in range(10)]

    loaded = error_report.load_dev(spark, files["corpus"], files["dev_ids"], f"{out}/dev.txt", f"{out}/dev_probs")
    rows = loaded.orderBy("row_no").collect()
    assert [(r["par_id"], r["pred"]) for r in rows] == [(p, int(y)) for p, y in files["dev"]]
    assert all(r["correct"] == 1 and r["token_count"] >= 8 for r in rows)
    flipped = loaded.withColumn("pred", F.when(F.col("row_no") < 3, 1 - F.col("pred")).otherwise(F.col("pred")))
    tables = error_report.error_report(flipped)
    assert sum(tables["error_totals"].first()) == 3
    assert tables["error_sample"].count() == 3
    assert sum(r["n"] for r in tables["confusion"].collect()) == 20
    assert sum(r["total"] for r in tables["by_keyword"].collect()) == 20
    assert sum(r["n"] for r in tables["by_length"].collect()) == 20
    assert tables["average_precision"].first()[0] == pytest.approx(1.0)
    assert tables["operating_point"].count() == 1

    with pytest.raises(Exception, match="differ in length"):
        short = put(tmp_path / "short", "dev.txt", "1\n0\n")
        error_report.load_dev(spark, files["corpus"], files["dev_ids"], short).count()


def test_best_model_is_the_logged_one(spark):
    rng = random.Random(13)
    rows = [(f"w{rng.randint(0, 9)} {'bad' if i % 4 == 0 else 'fine'}", int(i % 4 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "text string, label int")
    params = classify.Params(features=64, max_iter=10, max_tokens=None, min_doc_freq=0)
    weights = splits.class_weights(df, "label")
    single = classify.score(classify.fit_classifier(df, "text", "label", weights, params), df)
    assert single.columns == ["text", "label", "prob"]
    best, log = classify.run_trials(df, df, [classify.Params(features=64, max_iter=0, max_tokens=None, min_doc_freq=0), params])
    assert [r["improved"] if "improved" in r else None for r in log.collect()] == [None, None]
    again = classify.score(best, df)
    assert [round(r["prob"], 5) for r in again.collect()] == [round(r["prob"], 5) for r in single.collect()]
    seen = []
    grid = [classify.Params(features=64, max_iter=0, reg=r) for r in (0.1, 0.2)]
    one_class = df.withColumn("label", F.lit(0)).union(df.limit(1).withColumn("label", F.lit(1)))
    classify.run_trials(one_class, df.withColumn("label", F.lit(0)), grid, after_trial=lambda row, model: seen.append((row.first()["epoch"], model is not None)))
    assert seen == [(1, True), (2, True)]  # without any F1 above 0 the last model stays
    decided = classify.predict(best, df, 0.5)
    assert decided.where("pred = label").count() == 200


def test_corpus_report(spark, files):
    from labelgrain.sources.readers import read_graded

    tables = corpus_report.corpus_report(read_graded(spark, files["corpus"]))
    assert [(r["binary_label"], r["n"]) for r in tables["classes"].collect()] == [(0, 40), (1, 20)]
    stats = {r["scope"]: r for r in tables["token_stats"].collect()}
    assert stats["overall"]["n"] == 60 and stats["1"]["mean"] == 8.0
    assert tables["histogram"].agg(F.sum("n")).first()[0] == 60
    first = tables["bigrams"].where("binary_label = 1 and rank = 1").first()
    assert (first["ngram"], first["n"]) == ("poor helpless", 20)
    flips = corpus_report.baseline(read_graded(spark, files["corpus"]), 7)
    assert {len(r["vector"]) for r in flips.collect()} == {7}
    assert corpus_report.baseline(spark.range(5), 1, key=None).count() == 5


def test_annotation_file_takes_little_disk(spark, tmp_path):
    """The file holds each text several times; on disk, copies and the shuffle that orders them take little."""
    rng = random.Random(3)
    rows = [(i, base64.b64encode(rng.randbytes(2_000)).decode(), "en", "src", 2_000) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    own = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    walk = lambda *tops: {os.path.join(at, f) for top in tops for at, _, names in os.walk(top) for f in names}
    shuffles = lambda: {f for f in walk(*own) if os.path.basename(f).startswith("shuffle_")}
    kept = spark.conf.get("spark.checkpoint.dir")
    files, before = walk(kept), shuffles()
    found = table_queries.annotation_file(spark, str(tmp_path))
    made = [f for f in walk(kept) - files if "/annotations-" in f]
    assert made and sum(map(os.path.getsize, made)) < 2 * sum(len(r[1]) for r in rows)
    end = time.time() + 10
    while shuffles() - before and time.time() < end:
        time.sleep(0.05)
    assert not shuffles() - before
    by_id = {int(r.par_id): r for r in found.collect()}
    assert sorted(by_id) == [i for i in range(500) if i % 128]
    assert all(r.text == hashlib.md5(rows[i][1].encode()).hexdigest() for i, r in by_id.items())
    assert all(sorted(map(int, r.ids.split(","))) == [k for k in range(7) if i >> k & 1] for i, r in by_id.items())
