"""Candle anatomy and candlestick patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.functions.scalars import flag, ratio
from voltide.plans.layout import block_window, blocked, with_row_index, without_halo


def anatomy(df: DataFrame) -> DataFrame:
    """Body and wicks, absolute and as shares of the range (null if range 0)."""
    o, h, l, c = (F.col(n) for n in ("open", "high", "low", "close"))
    parts = {
        "body": F.abs(c - o),
        "upper_wick": h - F.greatest(o, c),
        "lower_wick": F.least(o, c) - l,
    }
    df = df.withColumns(parts)
    return df.withColumns({f"{p}_pct": ratio(F.col(p), h - l) for p in parts})


def doji() -> Column:
    return flag(F.col("body_pct") <= 0.10)


def hammer() -> Column:
    return flag((F.col("lower_wick_pct") >= 0.60) & (F.col("upper_wick_pct") <= 0.15) & (F.col("body_pct") <= 0.30))


def engulfing(prev_open: Column, prev_close: Column) -> dict[str, Column]:
    o, c = F.col("open"), F.col("close")
    return {
        "pat_engulf_bull": flag((prev_close < prev_open) & (c > o) & (o <= prev_close) & (c >= prev_open)),
        "pat_engulf_bear": flag((prev_close > prev_open) & (c < o) & (o >= prev_close) & (c <= prev_open)),
    }


def single_bar_patterns(df: DataFrame) -> DataFrame:
    """Doji and hammer: a projection, no shuffle."""
    return anatomy(df).withColumns({"pat_doji": doji(), "pat_hammer": hammer()})


def patterns(df: DataFrame) -> DataFrame:
    """All four patterns; engulfing looks one bar back."""
    panel = df if "row_idx" in df.columns else with_row_index(df)
    w = block_window()
    panel = blocked(single_bar_patterns(panel), back=1)
    panel = panel.withColumns(engulfing(F.lag("open", 1).over(w), F.lag("close", 1).over(w)))
    return without_halo(panel)
