"""Splits, trials, threshold and prediction files from raw inputs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgrain.functions.labels import normalise_key, vote_label
from labelgrain.operators import classify, focal, splits, trials
from labelgrain.operators.shared import stored
from labelgrain.sources import sinks
from labelgrain.sources.readers import read_graded, read_split, read_unlabelled


def load_splits(
    spark: SparkSession, corpus_path: str, train_ids: str, dev_ids: str, test_path: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train rows with collapsed grades, dev rows with vote labels, test rows."""
    corpus = read_graded(spark, corpus_path).withColumn("par_id", normalise_key(F.col("par_id")))
    train = splits.keep_split(corpus, read_split(spark, train_ids), "par_id")
    votes = read_split(spark, dev_ids).withColumn("binary_label", vote_label(F.col("label"))).drop("label")
    dev = splits.attach_in_order(votes, corpus.select("row_no", "par_id", "text"), "par_id", renumber=True)
    dev = splits.replace_label(dev, "label", "binary_label")
    return train, dev, read_unlabelled(spark, test_path)


def train_and_predict(
    spark: SparkSession, train: DataFrame, dev: DataFrame, test: DataFrame, out_dir: str,
    grid: Sequence[classify.Params] = (classify.Params(),),
) -> tuple[PipelineModel, DataFrame]:
    """Run the trials, then write labels and probabilities.

    Below ``out_dir``: ``training_metrics`` (appended) and ``model``, both
    written after each trial, ``dev.txt``, ``test.txt`` and ``dev_probs``.
    """

    def keep(row: DataFrame, best: PipelineModel | None) -> None:
        sinks.append_metrics(row, f"{out_dir}/training_metrics")
        if best is not None:
            best.write().overwrite().save(f"{out_dir}/model")

    model, log = classify.run_trials(train, dev, grid, after_trial=keep)
    threshold = trials.best_trial(log).first()["threshold"]
    _write_predictions(out_dir, *(classify.predict(model, part, threshold) for part in (dev, test)))
    return model, log


def _write_predictions(out_dir: str, dev: DataFrame, test: DataFrame) -> None:
    # narrow columns are stored, so that sorting and writing score no text again
    dev_scored, test_scored = (stored(part.select("row_no", "prob", "pred")) for part in (dev, test))
    sinks.write_label_lines(dev_scored, f"{out_dir}/dev.txt", "pred")
    sinks.write_probs(dev_scored, f"{out_dir}/dev_probs")
    sinks.write_label_lines(test_scored, f"{out_dir}/test.txt", "pred")


def train_by_epoch(
    spark: SparkSession, train: DataFrame, dev: DataFrame, test: DataFrame, out_dir: str, settings: focal.Settings = focal.Settings(),
) -> tuple[focal.Model, DataFrame]:
    """Train on the focal loss epoch by epoch, then write labels and probabilities.

    Below ``out_dir``: ``training_state`` and ``training_metrics``, written after each
    epoch, ``model``, ``dev.txt``, ``test.txt`` and ``dev_probs``. Run again
    after a failure, it goes on behind the last epoch in the metrics; an epoch
    that is run twice has one row there. Run again with other data or settings,
    it needs another folder.
    """
    metrics = f"{out_dir}/training_metrics"
    logged = sinks.recorded_metrics(spark, metrics, focal.LOG_SCHEMA)
    model, log = focal.train_epochs(
        train, dev, settings, state_dir=f"{out_dir}/training_state", logged=logged,
        after_epoch=lambda row: sinks.record_metrics(row, metrics),
    )
    focal.write_model(model, spark, f"{out_dir}/model")
    threshold = trials.best_trial(log).first()["threshold"]
    _write_predictions(out_dir, *(focal.predict(model, part, threshold, "text") for part in (dev, test)))
    return model, log
