"""A linear text classifier trained on the focal loss, epoch by epoch.

A text is the hashes of its words, once per occurrence, and its log-odds are a
bias and the mean of its words' weights, each by the inverse document frequency.
An epoch is one step of L-BFGS along the gradient of the class-weighted, smoothed
focal loss over all training rows: tasks sum it up per feature over their own rows,
as vectors, and the sums are added in a shuffle. What reaches the driver is
as long as ``features``, whatever the number of rows. After each epoch the model is
judged on dev rows, and its weights and gradient are stored, so that a job that
dies goes on from its last whole epoch.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelgrain.fixed_values import DEFAULT_THRESHOLD, FOCAL_GAMMA, LABEL_SMOOTHING
from labelgrain.functions import numbers as N
from labelgrain.functions.labels import fail_when
from labelgrain.operators.curves import threshold_sweep
from labelgrain.operators.shared import stored
from labelgrain.operators.splits import class_weights

LOG_SCHEMA = "epoch int, train_loss double, dev_f1_05 double, best_tuned_f1 double, threshold double"
STATE_SCHEMA = "feature int, weight double, gradient double"
#: Words of a batch that are worked on at once; a row of more is taken alone. Memory follows neither rows nor batches.
CHUNK_WORDS = 1 << 18


@dataclass(frozen=True)
class Settings:
    """``features`` bounds what the driver holds; ``memory`` is the number of earlier steps that L-BFGS looks at."""

    features: int = 1 << 18
    epochs: int = 10
    reg: float = 1e-4
    gamma: float = FOCAL_GAMMA
    smoothing: float = LABEL_SMOOTHING
    max_tokens: int | None = None
    min_doc_freq: int = 0
    memory: int = 8


@dataclass(frozen=True)
class Model:
    """A weight per feature and, last, the bias; the inverse document frequencies are in the weights."""

    weights: np.ndarray
    settings: Settings


def word_features(df: DataFrame, text_col: str, settings: Settings) -> DataFrame:
    """``df`` with ``_words``, the hashes of its text's words, in place of its text; a null text has none."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")
    if settings.max_tokens is not None:
        words = F.slice(words, 1, settings.max_tokens)
    hashes = F.transform(words, lambda w: F.pmod(F.hash(w), F.lit(settings.features)))
    return df.withColumn("_words", hashes).drop(text_col)


def document_frequencies(rows: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """The inverse document frequency of every feature, 0 for those of too few texts, and the number of texts.

    Frequencies and the number of texts are counted in one pass.
    """
    seen = rows.select(F.explode(F.concat(F.array_distinct("_words"), F.array(F.lit(settings.features)))).alias("feature"))
    counts = np.zeros(settings.features + 1)
    table = seen.groupBy("feature").agg(F.count("*").alias("n")).toArrow()
    counts[table["feature"].to_numpy()] = table["n"].to_numpy()
    n, counts = counts[-1], counts[:-1]
    return np.where(counts >= settings.min_doc_freq, np.log((n + 1) / (counts + 1)), 0.0), int(n)


def log_sigmoid(x: np.ndarray) -> np.ndarray:
    return np.minimum(x, 0.0) - np.log1p(np.exp(-np.abs(x)))


def focal_terms(margins: np.ndarray, labels: np.ndarray, alphas: np.ndarray, gamma: float, smoothing: float) -> tuple[np.ndarray, np.ndarray]:
    """``numbers.focal_loss`` of some rows and its derivative by their log-odds."""
    sign = np.where(labels == 1, 1.0, -1.0)
    right, wrong = log_sigmoid(sign * margins), log_sigmoid(-sign * margins)
    entropy = -((1.0 - smoothing) * right + smoothing * wrong)
    focus = alphas * np.exp(gamma * wrong)
    p = np.exp(right)
    return focus * entropy, -sign * focus * (gamma * p * entropy + 1.0 - smoothing - p)


def word_lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The features of a batch in a row, the row of each, and how many a row has."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes), sizes


def word_chunks(column: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Neighbouring rows of a batch with at most ``CHUNK_WORDS`` words, and the first one's place."""
    ends = np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(column):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + CHUNK_WORDS, side="right")))
        yield at, column.slice(at, end - at)
        at = end


def margins_of(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Log-odds: the bias and the mean weight of the words."""
    margins = np.full(len(column), weights[-1])
    for at, chunk in word_chunks(column):
        words, rows, sizes = word_lists(chunk)
        margins[at : at + len(sizes)] += np.bincount(rows, weights[words], len(sizes)) / np.maximum(sizes, 1)
    return margins


def loss_and_gradient(rows: DataFrame, label_col: str, weights: np.ndarray, settings: Settings) -> tuple[float, np.ndarray]:
    """The mean focal loss of ``rows`` and its gradient by ``weights``, the bias last, in one pass.

    ``rows`` has ``_words``, the label and ``_alpha``, its class weight. A task
    sums over its rows, whatever their number, and sends one number a feature
    that it has seen; these are added up in as many tasks as there are partitions.
    """
    n, gamma, smoothing = settings.features, settings.gamma, settings.smoothing
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # behind the gradient: the loss and the number of rows
        sums = np.zeros(n + 3)
        for batch in batches:
            m = margins_of(batch.column(0), shared.value)
            labels, alphas = (c.to_numpy(zero_copy_only=False) for c in batch.columns[1:])
            loss, slope = focal_terms(m, labels, alphas, gamma, smoothing)
            for first, chunk in word_chunks(batch.column(0)):
                words, at, sizes = word_lists(chunk)
                sums[:n] += np.bincount(words, (slope[first : first + len(sizes)] / np.maximum(sizes, 1))[at], n)
            sums[n:] += slope.sum(), loss.sum(), len(m)
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(sums[used])], names=["feature", "total"])

    parts = rows.select("_words", label_col, "_alpha").mapInArrow(work, "feature int, total double")
    table = parts.groupBy("feature").agg(F.sum("total").alias("total")).toArrow()
    # a pass's weights would else stay on the disks to the end
    shared.destroy()
    sums = np.zeros(n + 3)
    sums[table["feature"].to_numpy()] = table["total"].to_numpy()
    count = max(sums[n + 2], 1.0)
    return float(sums[n + 1] / count), sums[: n + 1] / count


def direction(gradient: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The downhill direction of L-BFGS from earlier ``steps``: how weights and gradient changed, oldest first."""
    q, pairs = gradient.copy(), []
    useful = [(s, y) for s, y in steps if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y))]
    for s, y in reversed(useful):
        a = (s @ q) / (s @ y)
        pairs.append(a)
        q -= a * y
    if useful:
        s, y = useful[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(useful, reversed(pairs), strict=True):
        q += s * (a - (y @ q) / (s @ y))
    return -q


class Trainer:
    """Training rows and the loss over them; ``weights`` are by plain word counts, without document frequencies."""

    def __init__(self, train: DataFrame, text_col: str, label_col: str, settings: Settings) -> None:
        self.settings, self.label_col = settings, label_col
        two = {r["label"]: r["weight"] for r in class_weights(train, label_col).where(F.col("label").isin(0, 1)).collect()}
        label = F.col(label_col)
        alpha = F.when(label == 1, F.lit(two.get(1))).when(label == 0, F.lit(two.get(0)))
        alpha = fail_when(alpha.isNull(), "a label has no class weight", alpha)
        features = word_features(train.select(text_col, label_col), text_col, settings)
        self.rows = stored(features.withColumn("_alpha", alpha))
        self.idf, _ = document_frequencies(self.rows, settings)
        self.scale = np.append(self.idf, 1.0)

    def at(self, weights: np.ndarray) -> tuple[float, float, np.ndarray]:
        """The loss, the loss with the penalty on all weights but the bias, and the gradient of that."""
        loss, gradient = loss_and_gradient(self.rows, self.label_col, weights * self.scale, self.settings)
        plain = np.append(weights[:-1], 0.0)
        return loss, loss + self.settings.reg / 2 * float(plain @ plain), gradient * self.scale + self.settings.reg * plain

    def step(self, weights: np.ndarray, value: float, gradient: np.ndarray, steps: list) -> tuple[np.ndarray, float, float, np.ndarray]:
        """New weights with a lower value, found by halving the step; the old ones if there are none."""
        way = direction(gradient, steps)
        slope = float(gradient @ way)
        if slope >= 0:
            way, slope = -gradient, -float(gradient @ gradient)
        # without an earlier step the length of the first is a guess
        length = 1.0 if steps else 10.0 / max(float(np.linalg.norm(way)), 1e-12)
        for _ in range(30):
            found = weights + length * way
            loss, new, slopes = self.at(found)
            if new <= value + 1e-4 * length * slope:
                return found, loss, new, slopes
            length /= 2
        loss, new, slopes = self.at(weights)
        return weights, loss, new, slopes

    def model(self, weights: np.ndarray) -> Model:
        return Model(weights * self.scale, self.settings)


def _state_table(spark: SparkSession, weights: np.ndarray, gradient: np.ndarray) -> DataFrame:
    # the bias is always there, so that there is a row
    used = np.union1d(np.flatnonzero((weights != 0) | (gradient != 0)), [len(weights) - 1])
    return spark.createDataFrame(pa.table({"feature": used.astype(np.int32), "weight": weights[used], "gradient": gradient[used]}))


def read_state(spark: SparkSession, folder: str, epoch: int, features: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Weights and gradient after ``epoch``, or None if none were stored."""
    try:
        table = spark.read.schema(STATE_SCHEMA).parquet(f"{folder}/epoch={epoch}").toArrow()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    weights, gradient = np.zeros(features + 1), np.zeros(features + 1)
    at = table["feature"].to_numpy()
    weights[at], gradient[at] = table["weight"].to_numpy(), table["gradient"].to_numpy()
    return weights, gradient


def judge(model: Model, dev: DataFrame, label_col: str) -> tuple[float, float, float]:
    """F1 at one half, the best F1 of the threshold grid and its threshold, on rows with ``_words``.

    One half is on the grid: decisions are made in single precision.
    """
    sweep = threshold_sweep(score(model, dev).select(label_col, "prob"), "prob", label_col).select("threshold", "f1").collect()
    half = next(r["f1"] for r in sweep if np.float32(r["threshold"]) == np.float32(DEFAULT_THRESHOLD))
    best = max(sweep, key=lambda r: (r["f1"], -r["threshold"]))
    return half, best["f1"], best["threshold"] if best["f1"] > 0 else DEFAULT_THRESHOLD


def train_epochs(
    train: DataFrame, dev: DataFrame, settings: Settings = Settings(), text_col: str = "text", label_col: str = "label",
    state_dir: str | None = None, logged: DataFrame | None = None, after_epoch: Callable[[DataFrame], None] | None = None,
) -> tuple[Model, DataFrame]:
    """Train for ``settings.epochs`` and return the best epoch's model and the log.

    The best epoch is the earliest with the highest tuned dev F1, or the last one
    if none is above 0. Labels are 0 and 1; others raise. With ``state_dir`` each
    epoch's weights and gradient are stored there, and ``logged``, what an
    earlier run has logged, says which epochs need not be run again: those before
    the first that is missing in the log or in the folder. ``after_epoch`` gets each
    new row of the log, once what it tells of is stored. Without training rows
    all weights stay 0.
    """
    spark = train.sparkSession
    trainer = Trainer(train, text_col, label_col, settings)
    judged = stored(word_features(dev.select(text_col, label_col), text_col, settings))
    done = {r["epoch"]: tuple(r) for r in logged.select("epoch", "train_loss", "dev_f1_05", "best_tuned_f1", "threshold").collect()} if logged is not None else {}
    weights = np.zeros(settings.features + 1)
    _, value, gradient = trainer.at(weights)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    rows: list[tuple] = []
    best_f1, best = 0.0, weights
    for epoch in range(1, settings.epochs + 1):
        state = read_state(spark, state_dir, epoch, settings.features) if state_dir and epoch in done else None
        if state is not None:
            new, slopes = state
            row = done[epoch]
        else:
            # what a later run may have left is of no use after this
            done = {}
            if value is None:
                value = trainer.at(weights)[1]
            new, loss, value, slopes = trainer.step(weights, value, gradient, steps)
            if state_dir:
                _state_table(spark, new, slopes).write.mode("overwrite").parquet(f"{state_dir}/epoch={epoch}")
            row = (epoch, loss, *judge(trainer.model(new), judged, label_col))
        if np.any(new != weights):
            steps = [*steps, (new - weights, slopes - gradient)][-settings.memory :]
        weights, gradient = new, slopes
        if state is not None:
            value = None
        elif after_epoch:
            after_epoch(spark.createDataFrame([row], LOG_SCHEMA))
        rows.append(row)
        if row[3] > best_f1 or not best_f1:
            best_f1, best = row[3], weights
    return trainer.model(best), spark.createDataFrame(rows, LOG_SCHEMA)


def score(model: Model, df: DataFrame, text_col: str | None = None, prob_col: str = "prob", margin_col: str | None = None) -> DataFrame:
    """``df`` with the single-precision probability of class 1, and with its log-odds if they are named.

    ``df`` has ``_words``, or texts in ``text_col``, which stays. A text without words has
    the bias as its log-odds.
    """
    rows = df if text_col is None else word_features(df.withColumn("_text", F.col(text_col)), "_text", model.settings)
    weights = model.weights

    def work(words: pa.Array) -> pa.Array:
        return pa.array(margins_of(words, weights))

    # words alone go to Python, texts and other columns stay
    scored = rows.withColumn("_margin", F.arrow_udf(work, "double")("_words"))
    scored = scored if text_col is None else scored.drop("_words")
    scored = scored.withColumn(prob_col, (1.0 / (1.0 + F.exp(-F.col("_margin")))).cast("float"))
    return (scored.withColumn(margin_col, F.col("_margin")) if margin_col else scored).drop("_margin")


def predict(model: Model, df: DataFrame, threshold: float, text_col: str | None = None, pred_col: str = "pred") -> DataFrame:
    """``df`` with ``prob`` and the decision at ``threshold``."""
    return score(model, df, text_col).withColumn(pred_col, N.decide(F.col("prob"), threshold))


def write_model(model: Model, spark: SparkSession, path: str) -> None:
    """The weights as a table in Parquet, with the settings in every row."""
    table = _state_table(spark, model.weights, np.zeros(len(model.weights))).drop("gradient")
    table.withColumn("settings", F.lit(json.dumps(asdict(model.settings)))).write.mode("overwrite").parquet(path)


def read_model(spark: SparkSession, path: str) -> Model:
    table = spark.read.schema("feature int, weight double, settings string").parquet(path)
    settings = Settings(**json.loads(table.select("settings").first()["settings"]))
    found = table.select("feature", "weight").toArrow()
    weights = np.zeros(settings.features + 1)
    weights[found["feature"].to_numpy()] = found["weight"].to_numpy()
    return Model(weights, settings)
