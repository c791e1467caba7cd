"""Sinks and sources of derived tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_processed(df: DataFrame, path: str, partition_by: Sequence[str] = ("split",)) -> None:
    """Parquet, one folder per split, so reading one split prunes the others.
    Rows are spread by series and month to keep the files of a split even."""
    keys = [c for c in partition_by if c in df.columns]
    spread = [F.col(c) for c in (*keys, "series_id") if c in df.columns]
    if "date" in df.columns:
        spread.append(F.trunc(F.col("date").cast("date"), "quarter"))
    writer = df.repartition(*spread) if spread else df
    writer.write.mode("overwrite").partitionBy(*keys).parquet(path)


def load_processed(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


PREDICTION_KEYS = ("series_id", "date", "y_true")


def predictions_wide(preds: DataFrame, models: Sequence[str], value: str = "y_pred") -> DataFrame:
    """One row per series and date, one column per model."""
    return (
        preds.groupBy(*PREDICTION_KEYS).pivot("model", list(models)).agg(F.first(value, ignorenulls=True))
    )


def predictions_long(wide: DataFrame, models: Sequence[str], value: str = "y_pred") -> DataFrame:
    long = wide.unpivot(list(PREDICTION_KEYS), list(models), "model", value)
    return long.where(F.col(value).isNotNull())


def save_predictions(preds: DataFrame, path: str) -> None:
    preds.write.mode("overwrite").partitionBy("model").parquet(path)


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("model", F.col("model").cast("string"))


def save_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("overwrite").json(path)


def load_metrics(spark: SparkSession, path: str) -> DataFrame:
    schema = "scope string, model string, metric string, value double"
    return spark.read.schema(schema).json(path)


def metrics_long(table: DataFrame, scope: str, metrics: Sequence[str]) -> DataFrame:
    """Long form ``(scope, model, metric, value)`` of a model table."""
    return (
        table.select("model", *[F.col(m).cast("double").alias(m) for m in metrics])
        .unpivot(["model"], list(metrics), "metric", "value")
        .select(F.lit(scope).alias("scope"), "model", "metric", "value")
    )


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def usable_rows(df: DataFrame, features: Sequence[str], targets: Sequence[str]) -> DataFrame:
    """Rows that have all features and a target, for several targets in one pass."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in features])
    counts = df.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(known & F.col(t).isNotNull()).alias(t) for t in targets],
    )
    return counts.unpivot(["series_id", "n_rows"], list(targets), "target", "usable")
