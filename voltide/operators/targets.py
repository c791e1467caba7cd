"""Forward-looking targets and volatility regimes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from voltide.functions.scalars import flag
from voltide.operators.features import build_features
from voltide.plans.layout import block_window, blocked, with_row_index, without_halo
from voltide.plans.ranking import exact_quantiles
from voltide.settings import HORIZONS, PRIMARY_HORIZON


def regression_targets(w: WindowSpec, horizons: Sequence[int] = HORIZONS) -> dict[str, Column]:
    return {f"target_vol_{h}": F.lead(f"vol_{h}", h).over(w) for h in horizons}


def class_target(w: WindowSpec, horizon: int = PRIMARY_HORIZON, null_label: str = "zero") -> dict[str, Column]:
    """1 when volatility rises over the horizon. Rows without a future value
    are 0, or null with ``null_label='null'``."""
    rises = F.lead(f"vol_{horizon}", horizon).over(w) > F.col(f"vol_{horizon}")
    return {"target_class": flag(rises) if null_label == "zero" else rises.cast("int")}


def all_targets(w: WindowSpec) -> dict[str, Column]:
    return {**regression_targets(w), **class_target(w)}


def require(df: DataFrame, columns: Sequence[str]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {', '.join(missing)}")


def _ahead(df: DataFrame, horizon: int, columns) -> DataFrame:
    panel = df if {"row_idx", "n_rows"} <= set(df.columns) else with_row_index(df)
    return without_halo(blocked(panel, ahead=horizon).withColumns(columns(block_window())))


def add_regression_targets(df: DataFrame, horizons: Sequence[int] = HORIZONS) -> DataFrame:
    require(df, [f"vol_{h}" for h in horizons])
    return _ahead(df, max(horizons), lambda w: regression_targets(w, horizons))


def add_class_target(df: DataFrame, horizon: int = PRIMARY_HORIZON, null_label: str = "zero") -> DataFrame:
    require(df, [f"vol_{horizon}"])
    return _ahead(df, horizon, lambda w: class_target(w, horizon, null_label))


def add_all_targets(df: DataFrame) -> DataFrame:
    require(df, [f"vol_{h}" for h in HORIZONS])
    return _ahead(df, max(HORIZONS), all_targets)


def features_and_targets(bars: DataFrame) -> DataFrame:
    """Features and all targets in one pass over the panel."""
    return build_features(bars, ahead=max(HORIZONS), extra=all_targets)


def regime_borders(
    df: DataFrame, column: str = "vol_21", n_regimes: int = 3, fit_splits: Sequence[str] = ("train",),
    keys: Sequence[str] = ("series_id",),
) -> DataFrame:
    """Exact quantile borders of the fitting rows: ``border_1 .. border_{n-1}``."""
    fit = df.where(F.col("split").isin(list(fit_splits)) & F.col(column).isNotNull())
    quantiles = {f"border_{i + 1}": (i + 1) / n_regimes for i in range(n_regimes - 1)}
    return exact_quantiles(fit, list(keys), column, quantiles)


def regime_label(value: Column, borders: Sequence[Column]) -> Column:
    """First regime whose border is not exceeded; -1 for an unknown value."""
    label = F.when(value.isNull(), -1)
    for i, border in enumerate(borders):
        label = label.when(value <= border, i)
    return label.otherwise(len(borders)).cast("int")


def add_regime_target(
    df: DataFrame, column: str = "vol_21", n_regimes: int = 3, fit_splits: Sequence[str] = ("train",),
    keys: Sequence[str] = ("series_id",),
) -> DataFrame:
    """Label all rows by borders learned on the fitting rows. The border table
    has one row per series; AQE broadcasts it only when it is small."""
    names = [f"border_{i + 1}" for i in range(n_regimes - 1)]
    borders = regime_borders(df, column, n_regimes, fit_splits, keys)
    joined = df.join(borders, list(keys), "left") if keys else df.join(F.broadcast(borders))
    return joined.withColumn("target_regime", regime_label(F.col(column), [F.col(b) for b in names])).drop(*names)
