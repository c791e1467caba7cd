"""Preprocessing fitted on training rows only: exact median, population scale."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.plans.ranking import column_quantiles


@dataclass(frozen=True)
class Prep:
    """Fitted values per feature (a few numbers, never rows) and the label
    statistics that the regularised models need."""

    features: tuple[str, ...]
    median: dict[str, float]
    mean: dict[str, float]
    std: dict[str, float]
    n: int
    y_std_pop: float = 1.0
    y_std_samp: float = 1.0
    extra: dict = field(default_factory=dict)

    def expression(self, c: str, scale: bool) -> str:
        filled = f"coalesce(CAST(`{c}` AS DOUBLE), CAST('{self.median[c]!r}' AS DOUBLE))"
        if not scale:
            return filled
        spread = self.std[c] if self.std[c] > 0 else 1.0
        return f"(({filled}) - CAST('{self.mean[c]!r}' AS DOUBLE)) / CAST('{spread!r}' AS DOUBLE)"


def median_table(train: DataFrame, features: Sequence[str]) -> DataFrame:
    return column_quantiles(train, features, {"median": 0.5})


def fit_prep(train: DataFrame, features: Sequence[str], label: str | None = None) -> Prep:
    """Two passes over the training rows: medians, then moments after filling."""
    features = tuple(features)
    median = {r["column"]: r["median"] for r in median_table(train, features).collect()}
    median = {c: (median.get(c) if median.get(c) is not None else 0.0) for c in features}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(median[c])) for c in features}
    y = F.col(label).cast("double") if label else F.lit(0.0)
    row = train.agg(
        F.count(F.lit(1)).alias("n"),
        F.stddev_pop(y).alias("yp"),
        F.stddev_samp(y).alias("ys"),
        *[F.avg(v).alias(f"m_{c}") for c, v in filled.items()],
        *[F.stddev_pop(v).alias(f"s_{c}") for c, v in filled.items()],
    ).first()
    return Prep(
        features,
        median,
        {c: row[f"m_{c}"] for c in features},
        {c: row[f"s_{c}"] for c in features},
        row["n"],
        row["yp"] or 0.0,
        row["ys"] or 0.0,
    )


def apply_prep(df: DataFrame, prep: Prep, scale: bool = True) -> DataFrame:
    """Replace the feature columns by their filled (and scaled) values."""
    return df.withColumns({c: F.expr(prep.expression(c, scale)) for c in prep.features})


def prep_stages(prep: Prep, scale: bool, output: str = "features") -> list:
    """Saveable pipeline stages: fill, scale, assemble."""
    columns = ", ".join(f"{prep.expression(c, scale)} AS `_f{i}`" for i, c in enumerate(prep.features))
    names = [f"_f{i}" for i in range(len(prep.features))]
    return [
        SQLTransformer(statement=f"SELECT *, {columns} FROM __THIS__"),
        VectorAssembler(inputCols=names, outputCol=output),
    ]


def fit_pipeline(train: DataFrame, prep: Prep, stages: Sequence, scale: bool = True) -> PipelineModel:
    """Fill -> scale -> model, fitted on ``train``; safe inside a fold because
    ``prep`` was fitted on the same rows."""
    return Pipeline(stages=[*prep_stages(prep, scale), *stages]).fit(train)


def class_weights(train: DataFrame, label: str = "target_class") -> DataFrame:
    """``balanced`` weights: n / (classes * n_class)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    total = counts.agg(F.sum("n_class").alias("_n"), F.count(F.lit(1)).alias("_k"))
    return counts.join(F.broadcast(total)).select(
        label, "n_class", (F.col("_n") / (F.col("_k") * F.col("n_class"))).alias("weight")
    )


def scale_pos_weight(train: DataFrame, label: str = "target_class") -> DataFrame:
    neg, pos = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return train.agg(neg.alias("n_neg"), pos.alias("n_pos"), F.try_divide(neg.cast("double"), pos).alias("scale_pos_weight"))


def with_weights(train: DataFrame, weights: DataFrame, label: str = "target_class") -> DataFrame:
    """Attach weights (one row per class)."""
    return train.join(F.broadcast(weights.select(label, "weight")), label)
