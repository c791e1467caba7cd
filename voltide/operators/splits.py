"""Temporal splits, expanding folds and reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.plans.layout import block_window, blocked, with_row_index, without_halo
from voltide.settings import CV_FOLDS, TRAIN_FRACTION, VALIDATION_FRACTION


class LeakageError(ValueError):
    """Two splits of a series share a date or are out of order."""


def _renumbered(df: DataFrame) -> DataFrame:
    return with_row_index(df.drop("row_idx", "n_rows", "volume_ffill"))


def _cut(fraction: float) -> Column:
    return F.floor(F.col("n_rows") * F.lit(float(fraction)))


def temporal_split(
    df: DataFrame, train: float = TRAIN_FRACTION, validation: float = VALIDATION_FRACTION
) -> DataFrame:
    """Add ``split`` by position in the series (train, val, test)."""
    place = F.col("row_idx")
    split = (
        F.when(place < _cut(train), "train").when(place < _cut(train + validation), "val").otherwise("test")
    )
    return _renumbered(df).withColumn("split", split)


def temporal_split_75_25(df: DataFrame, train: float = 0.75) -> DataFrame:
    split = F.when(F.col("row_idx") < _cut(train), "train").otherwise("test")
    return _renumbered(df).withColumn("split", split)


def split_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("series_id", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("date_min"), F.max("date").alias("date_max")
    )


def leakage_violations(df: DataFrame) -> DataFrame:
    """Series in which a split does not end before the next one begins."""
    ends = df.groupBy("series_id").agg(
        *[F.max(F.when(F.col("split") == s, F.col("date"))).alias(f"{s}_max") for s in ("train", "val")],
        *[F.min(F.when(F.col("split") == s, F.col("date"))).alias(f"{s}_min") for s in ("val", "test")],
    )
    after_train = F.coalesce("val_min", "test_min")
    after_val = F.col("test_min")
    return ends.where((F.col("train_max") >= after_train) | (F.col("val_max") >= after_val))


def assert_no_leakage(df: DataFrame) -> DataFrame:
    bad = leakage_violations(df).head(1)
    if bad:
        raise LeakageError(f"splits overlap in series {bad[0]['series_id']}")
    return df


def expanding_folds(df: DataFrame, n_splits: int = CV_FOLDS, gap: int = 0) -> DataFrame:
    """Rows labelled ``(fold, role)``: each fold trains on all rows before its
    test block, minus ``gap`` rows. A row is copied to the folds that use it."""
    size = F.floor(F.col("n_rows") / F.lit(float(n_splits + 1)))
    place = F.col("row_idx")
    uses = []
    for fold in range(n_splits):
        start = F.col("n_rows") - size * F.lit(n_splits - fold)
        role = F.when(place < start - F.lit(gap), "train").when((place >= start) & (place < start + size), "test")
        uses.append(F.struct(F.lit(fold).alias("fold"), role.alias("role")))
    panel = df if {"row_idx", "n_rows"} <= set(df.columns) else _renumbered(df)
    use = F.explode(F.filter(F.array(*uses), lambda u: u["role"].isNotNull()))
    return panel.select("*", use.alias("_use")).select("*", "_use.fold", "_use.role").drop("_use")


def history(df: DataFrame, splits: Sequence[str] = ("train", "val")) -> DataFrame:
    """Rows for the final fit."""
    return df.where(F.col("split").isin(list(splits)))


def lookback_sequences(df: DataFrame, columns: Sequence[str], lookback: int = 21) -> DataFrame:
    """The previous ``lookback`` rows of each row as an array of arrays; rows
    without full history are dropped. Runs before any split filter, so test
    rows see the end of the history."""
    panel = df if {"row_idx", "n_rows"} <= set(df.columns) else _renumbered(df)
    frame = block_window().rowsBetween(-lookback, -1)
    row = F.array(*[F.col(c).cast("double") for c in columns])
    out = blocked(panel, back=lookback).withColumn("sequence", F.collect_list(row).over(frame))
    return without_halo(out).where(F.size("sequence") == lookback)


def align_predictions(left: DataFrame, right: DataFrame, tolerance: float = 1e-8) -> DataFrame:
    """Join two wide prediction tables on (series, date). A row that only one
    of them has, or a differing true value, fails the job: the check is a
    filter, which stays whatever columns are selected later."""
    a = left.withColumn("_left", F.lit(True))
    b = right.withColumnRenamed("y_true", "_y_true").withColumn("_right", F.lit(True))
    joined = a.join(b, ["series_id", "date"], "full")
    both = F.col("_left").isNotNull() & F.col("_right").isNotNull()
    known = F.col("y_true").isNotNull() & F.col("_y_true").isNotNull()
    close = F.abs(F.col("y_true") - F.col("_y_true")) <= F.lit(tolerance) * (F.abs("_y_true") + F.lit(1.0))
    same = F.when(known, close).otherwise(F.col("y_true").isNull() == F.col("_y_true").isNull())
    failed = F.raise_error(F.lit("prediction tables differ in rows or in y_true")).cast("boolean")
    return joined.where(F.when(both & same, F.lit(True)).otherwise(failed)).drop("_y_true", "_left", "_right")


def complete_models(preds: DataFrame, expected_rows: DataFrame | None = None) -> DataFrame:
    """Keep the models of a long table that have a prediction for every row."""
    total = preds.select("series_id", "date").distinct().agg(F.count(F.lit(1)).alias("_total"))
    if expected_rows is not None:
        total = expected_rows.agg(F.count(F.lit(1)).alias("_total"))
    per_model = preds.groupBy("model").agg(F.count("y_pred").alias("_n"))
    whole = per_model.join(F.broadcast(total)).where(F.col("_n") == F.col("_total")).select("model")
    return preds.join(whole, "model", "left_semi")


def consolidate(tables: dict[str, DataFrame]) -> DataFrame:
    """Stack prediction tables with a ``category`` column."""
    out = None
    for category, table in tables.items():
        table = table.withColumn("category", F.lit(category))
        out = table if out is None else out.unionByName(table, allowMissingColumns=True)
    return out
