"""A class-weighted text classifier with Spark ML, its trials and predictions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgrain.fixed_values import DEFAULT_THRESHOLD
from labelgrain.functions import numbers as N
from labelgrain.functions.labels import fail_when
from labelgrain.operators.curves import best_threshold, threshold_sweep
from labelgrain.operators.metrics import binary_scores, dataset_loss
from labelgrain.operators.shared import stored
from labelgrain.operators.splits import class_weights

LOG_SCHEMA = "epoch int, train_loss double, dev_f1_05 double, best_tuned_f1 double, threshold double"


@dataclass(frozen=True)
class Params:
    """Settings of one trial. ``max_tokens`` cuts texts and ``min_doc_freq`` leaves out features of fewer texts."""

    features: int = 1 << 18
    max_iter: int = 20
    reg: float = 0.01
    elastic_net: float = 0.0
    max_tokens: int | None = None
    min_doc_freq: int = 0


def _term_stages(text_col: str, params: Params) -> list:
    words = f"filter(split(lower(coalesce(`{text_col}`, '')), '(?U)[\\\\s\\\\x1c-\\\\x1f]+'), t -> t <> '')"
    if params.max_tokens is not None:
        words = f"slice({words}, 1, {int(params.max_tokens)})"
    return [
        SQLTransformer(statement=f"SELECT *, {words} AS _tokens FROM __THIS__"),
        HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=params.features),
    ]


def _idf(params: Params) -> IDF:
    return IDF(inputCol="_tf", outputCol="_features", minDocFreq=params.min_doc_freq)


def term_vectors(df: DataFrame, text_col: str, params: Params = Params()) -> DataFrame:
    """``df`` with hashed term counts, ``_tf``, in place of its text; stored, so that texts are read once.

    The other functions here take it wherever they take texts.
    """
    terms = PipelineModel(stages=_term_stages(text_col, params)).transform(df)
    return stored(terms.drop("_tokens", text_col))


def _with_terms(df: DataFrame, text_col: str, params: Params) -> DataFrame:
    return df if "_tf" in df.columns else term_vectors(df, text_col, params)


def _regression(label_col: str, params: Params) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="_features", labelCol=label_col, weightCol="_weight", probabilityCol="_probability",
        rawPredictionCol="_raw", predictionCol="_prediction", maxIter=params.max_iter,
        regParam=params.reg, elasticNetParam=params.elastic_net, family="binomial",
    )


def _weighted(df: DataFrame, label_col: str, weights: DataFrame) -> DataFrame:
    """Add the class weight as ``_weight``: two numbers, written into the plan."""
    two = {r["label"]: r["weight"] for r in weights.where(F.col("label").isin(0, 1)).collect()}
    label = F.col(label_col)
    known = F.when(label == 1, F.lit(two.get(1))).when(label == 0, F.lit(two.get(0)))
    return df.withColumn("_weight", fail_when(known.isNull(), "a label has no class weight", known))


def fit_classifier(
    df: DataFrame, text_col: str, label_col: str, weights: DataFrame, params: Params = Params()
) -> PipelineModel:
    """Hashed TF-IDF and logistic regression, rows weighted by class; texts are tokenised once."""
    terms = _weighted(_with_terms(df, text_col, params), label_col, weights)
    learned = Pipeline(stages=[_idf(params), _regression(label_col, params)]).fit(terms)
    return PipelineModel(stages=[*_term_stages(text_col, params), *learned.stages])


def score(model: PipelineModel, df: DataFrame, prob_col: str = "prob", margin_col: str | None = None) -> DataFrame:
    """``df`` with the single-precision probability of class 1, and with its log-odds if they are named."""
    if "_tf" in df.columns:
        model = PipelineModel(stages=[s for s in model.stages if not isinstance(s, (SQLTransformer, HashingTF))])
    scored = model.transform(df)
    helpers = [c for c in scored.columns if c.startswith("_") and c not in df.columns]
    scored = scored.withColumn(prob_col, vector_to_array(F.col("_probability"))[1].cast("float"))
    if margin_col:
        scored = scored.withColumn(margin_col, vector_to_array(F.col("_raw"))[1])
    return scored.drop(*helpers)


def run_trials(
    train: DataFrame, dev: DataFrame, grid: Sequence[Params], text_col: str = "text",
    label_col: str = "label", after_trial: Callable[[DataFrame, PipelineModel | None], None] | None = None,
) -> tuple[PipelineModel, DataFrame]:
    """Fit every parameter set; return the best model and the log.

    The best trial is the earliest with the highest tuned dev F1, or the last one
    as long as none is above 0. ``after_trial`` gets each trial's log row, and
    its model if it is the best so far, so that a job that dies keeps what is
    done. Features are computed once per feature setting and kept for its
    trials; a trial sends four numbers to the driver.
    """
    if not grid:
        raise ValueError("grid is empty")
    spark = train.sparkSession
    weights = stored(class_weights(train, label_col))
    weighted = _weighted(train, label_col, weights)
    rows, best_model, best_f1, prepared = [], None, None, None
    for epoch, params in enumerate(grid, start=1):
        setting = (params.features, params.max_tokens, params.min_doc_freq)
        if prepared is None or prepared.setting != setting:
            if prepared is not None:
                prepared.release()
            prepared = _Prepared(setting, params, weighted, dev, text_col, label_col)
        regression = PipelineModel(stages=[_regression(label_col, params).fit(prepared.train)])
        fitted = score(regression, prepared.train, margin_col="_margin")
        loss = dataset_loss(fitted, "_margin", label_col, weights, log_odds=True).first()["loss"]
        scored = score(regression, prepared.dev).select(label_col, "prob")
        at_half = scored.withColumn("pred", N.decide(F.col("prob"), DEFAULT_THRESHOLD))
        f1_half = binary_scores(at_half, label_col, "pred").first()["f1"]
        tuned = best_threshold(threshold_sweep(scored, "prob", label_col)).first()
        rows.append((epoch, loss, f1_half, tuned["f1"], tuned["threshold"]))
        best_now = not best_f1 or tuned["f1"] > best_f1
        if best_now:
            best_f1 = tuned["f1"]
            best_model = PipelineModel(stages=[*prepared.stages, *regression.stages])
        if after_trial:
            after_trial(spark.createDataFrame(rows[-1:], LOG_SCHEMA), best_model if best_now else None)
    prepared.release()
    return best_model, spark.createDataFrame(rows, LOG_SCHEMA)


class _Prepared:
    """Features of train and dev rows for the trials that share a setting."""

    def __init__(self, setting, params, weighted, dev, text_col, label_col):
        self.setting = setting
        terms = _with_terms(weighted, text_col, params)
        self.idf = _idf(params).fit(terms)
        self.stages = [*_term_stages(text_col, params), self.idf]
        self.train = self._keep(terms, label_col, "_weight")
        self.dev = self._keep(_with_terms(dev, text_col, params), label_col)

    def _keep(self, terms, *cols):
        return self.idf.transform(terms).select(*cols, "_features").persist(StorageLevel.MEMORY_AND_DISK)

    def release(self):
        self.train.unpersist()
        self.dev.unpersist()


def predict(model: PipelineModel, df: DataFrame, threshold: float, pred_col: str = "pred") -> DataFrame:
    """``df`` with ``prob`` and the decision at ``threshold``."""
    return score(model, df).withColumn(pred_col, N.decide(F.col("prob"), threshold))
