"""Supervised forecasters as MLlib pipelines."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltide.operators.metrics import auc, classification_metrics, regression_metrics
from voltide.operators.prep import Prep, fit_pipeline, fit_prep
from voltide.settings import CV_FOLDS, SEED


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Random cosine features whose inner product approximates an rbf kernel
    (Rahimi and Recht 2007). Weights follow from the seed."""

    size = Param(Params._dummy(), "size", "number of features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="features", outputCol="fourier", size=256, gamma=1.0, seed=SEED):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, size=size, gamma=gamma, seed=seed)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        import numpy as np


        size, gamma, seed = (self.getOrDefault(p) for p in ("size", "gamma", "seed"))

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def project(x: pd.Series) -> pd.Series:
            rows = np.stack(x.to_numpy())
            draw = np.random.RandomState(seed)
            weights = draw.normal(scale=math.sqrt(2.0 * gamma), size=(rows.shape[1], size))
            shift = draw.uniform(0.0, 2.0 * math.pi, size)
            return pd.Series(list(math.sqrt(2.0 / size) * np.cos(rows @ weights + shift)))

        values = project(vector_to_array(F.col(self.getInputCol())))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(values))


@dataclass(frozen=True)
class Model:
    """``stages(prep)`` returns the estimator stages after preprocessing."""

    name: str
    task: str  # "regression" or "classification"
    stages: Callable[[Prep, str, str | None], list]
    scale: bool = True


def _weight(w: str | None) -> dict:
    return {"weightCol": w} if w else {}


def ridge(alpha: float = 1.0) -> Model:
    """The normal-equation solver scales its penalty by the population std."""

    def stages(prep: Prep, label: str, w: str | None) -> list:
        reg = alpha * prep.y_std_pop / prep.n
        return [LinearRegression(labelCol=label, elasticNetParam=0.0, standardization=False, solver="normal", regParam=reg, **_weight(w))]

    return Model("Ridge", "regression", stages)


def lasso(alpha: float = 0.001) -> Model:
    """Solved on the normal equations: one pass over the rows."""

    def stages(prep: Prep, label: str, w: str | None) -> list:
        return [
            LinearRegression(
                labelCol=label, elasticNetParam=1.0, standardization=False, solver="normal", regParam=alpha,
                maxIter=1000, tol=1e-10, **_weight(w),
            )
        ]

    return Model("Lasso", "regression", stages)


def elastic_net(alpha: float = 0.001, l1_ratio: float = 0.5) -> Model:
    def stages(prep: Prep, label: str, w: str | None) -> list:
        lam = alpha * l1_ratio + alpha * (1.0 - l1_ratio) * prep.y_std_pop
        return [
            LinearRegression(
                labelCol=label, elasticNetParam=alpha * l1_ratio / lam, standardization=False, regParam=lam,
                solver="normal", maxIter=1000, tol=1e-10, **_weight(w),
            )
        ]

    return Model("ElasticNet", "regression", stages)


def decision_tree(task: str, depth: int = 10) -> Model:
    kind = DecisionTreeRegressor if task == "regression" else DecisionTreeClassifier
    return Model(
        "Decision Tree", task,
        lambda prep, label, w: [kind(labelCol=label, maxDepth=depth, maxBins=256, seed=SEED, **_weight(w))], scale=False,
    )


def random_forest(task: str, trees: int = 200, depth: int = 10) -> Model:
    kind = RandomForestRegressor if task == "regression" else RandomForestClassifier
    subset = "all" if task == "regression" else "sqrt"
    return Model(
        "Random Forest", task,
        lambda prep, label, w: [
            kind(labelCol=label, numTrees=trees, maxDepth=depth, featureSubsetStrategy=subset, seed=SEED, **_weight(w))
        ], scale=False,
    )


def boosting(
    task: str, trees: int = 200, depth: int = 5, rate: float = 0.05, subsample: float = 1.0, columns: float = 1.0,
    name: str = "XGBoost",
) -> Model:
    kind = GBTRegressor if task == "regression" else GBTClassifier
    subset = "all" if columns >= 1.0 else str(columns)
    return Model(
        name, task,
        lambda prep, label, w: [
            kind(
                labelCol=label, maxIter=trees, maxDepth=depth, stepSize=rate, subsamplingRate=subsample,
                featureSubsetStrategy=subset, seed=SEED, **_weight(w),
            )
        ], scale=False,
    )


def boosted_300(trees: int = 300, depth: int = 6) -> Model:
    return boosting("regression", trees, depth, name="Boosted 300")


def rbf_svr(C: float = 1.0, size: int = 256) -> Model:
    def stages(prep: Prep, label: str, w: str | None) -> list:
        return [
            RandomFourierFeatures(inputCol="features", outputCol="fourier", size=size, gamma=1.0 / len(prep.features)),
            LinearRegression(featuresCol="fourier", labelCol=label, loss="huber", regParam=1.0 / (C * prep.n), maxIter=100, **_weight(w)),
        ]

    return Model("SVR", "regression", stages)


def rbf_svm(C: float = 1.0, size: int = 256) -> Model:
    """Linear SVM on Fourier features; a logistic fit on the margin gives the
    probability."""

    def stages(prep: Prep, label: str, w: str | None) -> list:
        return [
            RandomFourierFeatures(inputCol="features", outputCol="fourier", size=size, gamma=1.0 / len(prep.features)),
            LinearSVC(featuresCol="fourier", labelCol=label, predictionCol="_svm", rawPredictionCol="_margin", regParam=1.0 / (C * prep.n), **_weight(w)),
            VectorSlicer(inputCol="_margin", outputCol="_margin1", indices=[1]),
            LogisticRegression(featuresCol="_margin1", labelCol=label),
        ]

    return Model("SVM", "classification", stages)


def logistic(penalty: str = "l2", C: float = 1.0) -> Model:
    def stages(prep: Prep, label: str, w: str | None) -> list:
        return [
            LogisticRegression(
                labelCol=label, regParam=1.0 / (C * prep.n), elasticNetParam=1.0 if penalty == "l1" else 0.0,
                standardization=False, maxIter=200, tol=1e-8, **_weight(w),
            )
        ]

    return Model(f"LogReg {penalty.upper()}", "classification", stages)


def naive_bayes() -> Model:
    return Model(
        "Naive Bayes", "classification",
        lambda prep, label, w: [NaiveBayes(labelCol=label, modelType="gaussian", **_weight(w))], scale=False,
    )


def regression_models(trees: int = 200) -> list[Model]:
    return [
        ridge(), lasso(), elastic_net(), decision_tree("regression"), random_forest("regression", trees), rbf_svr(),
        boosting("regression", trees),
    ]


def classification_models(trees: int = 200) -> list[Model]:
    return [
        logistic("l1"), logistic("l2"), naive_bayes(), decision_tree("classification"),
        random_forest("classification", trees), rbf_svm(), boosting("classification", trees),
    ]


@dataclass
class Fitted:
    model: Model
    prep: Prep
    pipeline: object
    label: str
    seconds: float

    def predict(self, df: DataFrame) -> DataFrame:
        """Long prediction rows; classifiers add class and probability of 1."""
        out = self.pipeline.transform(df)
        keys = [c for c in ("series_id", "date", "split", "fold") if c in df.columns]
        columns = [F.lit(self.model.name).alias("model"), F.col(self.label).cast("double").alias("y_true")]
        if self.model.task == "regression":
            return out.select(*keys, *columns, F.col("prediction").alias("y_pred"))
        return out.select(
            *keys,
            *columns,
            F.col("prediction").cast("int").alias("y_class"),
            F.get(vector_to_array("probability"), 1).alias("y_score"),
        )


def fit_model(
    train: DataFrame, features: Sequence[str], label: str, model: Model, weight: str | None = None, prep: Prep | None = None
) -> Fitted:
    start = time.time()
    rows = train.where(F.col(label).isNotNull())
    if model.task == "classification":
        rows = rows.withColumn(label, F.col(label).cast("double"))
    prep = prep or fit_prep(rows, features, label)
    pipeline = fit_pipeline(rows, prep, model.stages(prep, label, weight), model.scale)
    return Fitted(model, prep, pipeline, label, time.time() - start)


def score_table(preds: DataFrame, task: str, keys: Sequence[str] = ("model",)) -> DataFrame:
    if task == "regression":
        return regression_metrics(preds, keys)
    return classification_metrics(preds, keys).join(auc(preds, keys).select(*keys, "auc"), list(keys))


def cross_validate(
    folds: DataFrame, features: Sequence[str], label: str, models: Iterable[Model], n_splits: int = CV_FOLDS, threads: int = 4
) -> DataFrame:
    """Expanding-window validation: preprocessing and model are refitted on
    the training rows of each fold. Returns predictions with ``fold``.

    ``folds`` is the table of :func:`voltide.operators.splits.expanding_folds`;
    pass a written table, since every fold reads it.
    """
    models = list(models)

    def run(task):
        fold, chosen = task
        here = folds.where(F.col("fold") == fold)
        train, test = here.where(F.col("role") == "train"), here.where(F.col("role") == "test")
        prep = fit_prep(train, features, label)
        return [fit_model(train, features, label, m, prep=prep).predict(test) for m in chosen]

    with ThreadPoolExecutor(threads) as pool:
        parts = [p for ps in pool.map(run, [(f, models) for f in range(n_splits)]) for p in ps]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def fit_and_score(
    table: DataFrame, features: Sequence[str], label: str, models: Iterable[Model], threads: int = 4
) -> tuple[DataFrame, list[Fitted]]:
    """Fit each model on train+val, predict the history and the test rows.
    Returns long predictions (``split`` = train or test) and the fits."""
    models = list(models)
    history = table.where(F.col("split") != "test")
    prep = fit_prep(history.where(F.col(label).isNotNull()), features, label)
    with ThreadPoolExecutor(threads) as pool:
        fits = list(pool.map(lambda m: fit_model(history, features, label, m, prep=prep), models))
    marked = table.withColumn("split", F.when(F.col("split") == "test", "test").otherwise("train"))
    out = None
    for fit in fits:
        one = fit.predict(marked)
        out = one if out is None else out.unionByName(one)
    return out, fits


def multi_horizon_ridge(table: DataFrame, features: Sequence[str], horizons: Sequence[int]) -> DataFrame:
    """Ridge for each horizon on the rows that have its target; test metrics."""
    out = None
    for h in horizons:
        label = f"target_vol_{h}"
        rows = table.where(F.col(label).isNotNull())
        preds, _ = fit_and_score(rows, features, label, [ridge()])
        one = regression_metrics(preds, ["model", "split"]).withColumn("horizon", F.lit(h))
        out = one if out is None else out.unionByName(one)
    return out


def gaussian_naive_bayes(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str = "target_class", smoothing: float = 1e-9
) -> DataFrame:
    """Closed form: class means and variances in one aggregation, then one
    expression per row. Returns ``y_score`` = P(class 1)."""
    features = list(features)
    row = train.agg(
        *[F.count_if(F.col(label) == k).alias(f"n{k}") for k in (0, 1)],
        *[F.avg(F.when(F.col(label) == k, F.col(c).cast("double"))).alias(f"m{k}_{c}") for k in (0, 1) for c in features],
        *[F.var_pop(F.when(F.col(label) == k, F.col(c).cast("double"))).alias(f"v{k}_{c}") for k in (0, 1) for c in features],
        *[F.var_pop(F.col(c).cast("double")).alias(f"a_{c}") for c in features],
    ).first()
    floor = smoothing * max(row[f"a_{c}"] for c in features)
    logs = []
    for k in (0, 1):
        constant = math.log(row[f"n{k}"] / (row["n0"] + row["n1"]))
        total = F.lit(0.0)
        for c in features:
            var = row[f"v{k}_{c}"] + floor
            constant -= 0.5 * math.log(2.0 * math.pi * var)
            gap = F.col(c).cast("double") - F.lit(row[f"m{k}_{c}"])
            total = total - gap * gap / F.lit(2.0 * var)
        logs.append(total + F.lit(constant))
    odds = F.greatest(F.least(logs[0] - logs[1], F.lit(700.0)), F.lit(-700.0))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(odds))
    return test.select(
        "series_id", "date", F.lit("Naive Bayes").alias("model"), F.col(label).alias("y_true"), score.alias("y_score")
    ).withColumn("y_class", (F.col("y_score") > 0.5).cast("int"))
