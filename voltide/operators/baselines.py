"""Naive, rolling-mean and exponentially weighted baselines."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltide.plans.layout import BLOCK_ROWS, block_window, blocked, with_row_index, without_halo

MODELS = ("Naive", "Rolling Mean", "EWMA")
ROLLING_WINDOW = 21
DECAY = 0.94
# A run of rows is scaled by powers of the decay down to about exp(-RUN_RANGE).
RUN_RANGE = 230.0
# Runs whose total weight is below exp(-CARRY_RANGE) cannot change a double.
CARRY_RANGE = 45.0


def ewma_weight(age: Column, first: Column, decay: float = DECAY) -> Column:
    """Weight of a value ``age`` rows before the end; the first value of the
    series seeds the recursion and keeps weight ``decay ** age``."""
    return F.pow(F.lit(decay), age) * F.when(first, F.lit(1.0)).otherwise(F.lit(1.0 - decay))


def fit_baselines(history: DataFrame, value: str, window: int = ROLLING_WINDOW, decay: float = DECAY) -> DataFrame:
    """Last value, mean of the last rows and EWMA per series: one aggregation."""
    rows = history.drop("row_idx", "n_rows").where(F.col(value).isNotNull())
    rows = with_row_index(rows)
    y, age = F.col(value), F.col("n_rows") - F.col("row_idx") - F.lit(1)
    return rows.groupBy("series_id").agg(
        F.max_by(y, F.col("date")).alias("Naive"),
        F.avg(F.when(age < window, y)).alias("Rolling Mean"),
        F.sum(y * ewma_weight(age.cast("double"), F.col("row_idx") == 0, decay)).alias("EWMA"),
    )


def baseline_forecasts(history: DataFrame, test: DataFrame, value: str) -> DataFrame:
    """Constant forecast path of each baseline over the test rows, long form."""
    fits = fit_baselines(history, value).unpivot(["series_id"], list(MODELS), "model", "y_pred")
    truth = test.select("series_id", "date", F.col(value).alias("y_true"))
    return truth.join(fits, "series_id").select("series_id", "date", "model", "y_true", "y_pred")


def running_ewma(rows: DataFrame, value: str, decay: float = DECAY, name: str = "ewma") -> DataFrame:
    """Adds the EWMA up to and including each row of a numbered table.

    The recursion is affine, so a series is cut into runs: inside a run it is a
    scaled running sum, and a small table of run totals gives what earlier runs
    carry in. Runs are short enough that no power overflows, whatever the decay.
    """
    if not 0 < decay < 1:
        raise ValueError("decay must lie between 0 and 1")
    size = max(1, min(BLOCK_ROWS, int(RUN_RANGE / -math.log(decay))))
    reach = max(1, math.ceil(CARRY_RANGE / (-math.log(decay) * size)))
    place = F.col("row_idx").cast("long")
    rows = rows.withColumns({"_run": F.call_function("div", place, F.lit(size).cast("long")), "_k": F.pmod(place, F.lit(size)).cast("double")})
    weight = F.when(place == 0, F.lit(1.0)).otherwise(F.lit(1.0 - decay))
    scaled = F.col(value) * weight * F.pow(F.lit(decay), -F.col("_k"))
    totals = rows.groupBy("series_id", "_run").agg((F.sum(scaled) * F.pow(F.lit(decay), F.max("_k"))).alias("_total"))
    before = Window.partitionBy("series_id").orderBy("_run").rowsBetween(-reach, -1)
    # Every run before the last is full: one step of the fold is a whole run.
    step = decay**size
    carry = totals.select("series_id", "_run", F.aggregate(F.collect_list("_total").over(before), F.lit(0.0), lambda a, p: a * F.lit(step) + p).alias("_carry"))
    inside = Window.partitionBy("series_id", "_run").orderBy("row_idx").rowsBetween(Window.unboundedPreceding, 0)
    own = F.sum(scaled).over(inside) * F.pow(F.lit(decay), "_k")
    rows = rows.withColumn("_own", own).join(carry, ["series_id", "_run"])
    return rows.withColumn(name, F.col("_own") + F.col("_carry") * F.pow(F.lit(decay), F.col("_k") + 1)).drop("_run", "_k", "_own", "_carry")


def walk_forward(
    df: DataFrame,
    value: str,
    horizon: int = 1,
    train_fraction: float = 0.70,
    window: int = ROLLING_WINDOW,
    decay: float = DECAY,
) -> DataFrame:
    """Expanding-window forecasts without refitting in a loop.

    The forecast for row ``i`` uses rows up to ``i - horizon``, which is a
    window frame. Rows before ``train_size + horizon - 1`` have no forecast.
    """
    rows = with_row_index(df.drop("row_idx", "n_rows").where(F.col(value).isNotNull()))
    rows = running_ewma(rows, value, decay, "_ewma")
    w = block_window()
    y = F.col(value)
    start = F.floor(F.col("n_rows") * F.lit(train_fraction)) + F.lit(horizon - 1)
    live = F.col("row_idx") >= start
    out = blocked(rows, back=window + horizon).withColumns(
        {
            "Naive": F.when(live, F.lag(y, horizon).over(w)),
            "Rolling Mean": F.when(live, F.avg(y).over(w.rowsBetween(-(horizon + window - 1), -horizon))),
            "EWMA": F.when(live, F.lag("_ewma", horizon).over(w)),
        }
    )
    return without_halo(out).drop("_ewma")


def walk_forward_predictions(df: DataFrame, value: str, horizon: int = 1, train_fraction: float = 0.70) -> DataFrame:
    """Long prediction table of :func:`walk_forward`."""
    wide = walk_forward(df, value, horizon, train_fraction).where(F.col("Naive").isNotNull())
    wide = wide.select("series_id", "date", F.col(value).alias("y_true"), *MODELS)
    return wide.unpivot(["series_id", "date", "y_true"], list(MODELS), "model", "y_pred")
