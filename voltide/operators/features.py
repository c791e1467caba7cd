"""Causal rolling features of a bar panel.

Each family is a dictionary of column expressions on one window; families are
applied level by level (returns, then rolling statistics, then lags), so the
whole feature table is computed in one blocked pass over the panel.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from voltide.functions.scalars import ratio
from voltide.plans.layout import block_window, blocked, rolling, with_row_index, without_halo
from voltide.settings import VOL_WINDOWS

RETURN_LAGS = (1, 2, 3, 5, 7, 10, 14, 21)
VOL_LAGS = (1, 2, 3, 5, 7, 14, 21)
MEAN_WINDOWS = (5, 10, 20)
RSI_PERIOD = STOCHASTIC_PERIOD = ATR_PERIOD = 14
BOLLINGER_PERIOD = 20
BOLLINGER_WIDTH = 2.0
# Rows of the narrow frames that all windows are multiples of.
SHORT, LONG = 5, 7

Columns = dict[str, Column]


def log_returns(w: WindowSpec) -> Columns:
    price = F.when(F.col("close") > 0, F.ln("close"))
    return {"log_ret": price - F.lag(price, 1).over(w)}


def part_statistics(w: WindowSpec) -> Columns:
    """Sums, means, variances and extremes of frames of ``SHORT`` and ``LONG`` rows.

    Spark adds up a moving frame anew for each row, so wide frames are put together
    from these narrow ones (``earlier_parts``). A part is null unless all its
    values are known, and so is what is made of it."""
    delta = F.col("_delta")
    gain = F.coalesce(F.when(delta > 0, delta), F.lit(0.0))
    loss = F.coalesce(F.when(delta < 0, -delta), F.lit(0.0))
    return {
        "_abs": rolling(F.abs("log_ret"), F.sum, w, SHORT),
        "_range": rolling("hl_range", F.sum, w, SHORT),
        "_ret": rolling("log_ret", F.sum, w, SHORT),
        "_volume": rolling(F.col("volume").cast("double"), F.sum, w, SHORT),
        "_close_mean": rolling("close", F.avg, w, SHORT),
        "_close_var": rolling("close", F.var_samp, w, SHORT),
        "_ret_mean": rolling("log_ret", F.avg, w, LONG),
        "_ret_var": rolling("log_ret", F.var_samp, w, LONG),
        "_gain": rolling(gain, F.sum, w, LONG),
        "_loss": rolling(loss, F.sum, w, LONG),
        "_low": rolling("low", F.min, w, LONG),
        "_high": rolling("high", F.max, w, LONG),
        "_tr": rolling("_true_range", F.sum, w, LONG),
    }


#: Rows of a part, and the most parts that a frame is put together from.
PARTS = {
    "_abs": (SHORT, 4), "_range": (SHORT, 4), "_ret": (SHORT, 4), "_volume": (SHORT, 2), "_close_mean": (SHORT, 4), "_close_var": (SHORT, 4),
    "_ret_mean": (LONG, 4), "_ret_var": (LONG, 4), "_gain": (LONG, 2), "_loss": (LONG, 2), "_low": (LONG, 2), "_high": (LONG, 2), "_tr": (LONG, 2),
}


def earlier_parts(w: WindowSpec) -> Columns:
    """``<part>_<k>``: the part that ends ``k`` parts before the row."""
    return {f"{c}_{k}": F.lag(c, k * rows).over(w) for c, (rows, most) in PARTS.items() for k in range(1, most)}


def in_parts(name: str, n: int) -> list[Column]:
    """The parts of ``name`` that make up the last ``n`` rows."""
    rows, most = PARTS[name]
    if n % rows or n // rows > most:
        raise ValueError(f"{n} rows of {name} are not up to {most} parts of {rows} rows")
    return [F.col(name), *[F.col(f"{name}_{k}") for k in range(1, n // rows)]]


def total(name: str, n: int) -> Column:
    return reduce(lambda a, b: a + b, in_parts(name, n))


def mean(name: str, n: int) -> Column:
    return total(name, n) / F.lit(float(n))


def deviation(values: str, n: int) -> Column:
    """Sample deviation of ``n`` rows from means and variances of parts; exactly 0
    where all values are equal."""
    means, variances, rows = in_parts(f"{values}_mean", n), in_parts(f"{values}_var", n), PARTS[f"{values}_mean"][0]
    if len(means) == 1:
        return F.sqrt(variances[0])
    inside = reduce(lambda a, b: a + b, variances) * F.lit(float(rows - 1))
    between = reduce(lambda a, b: a + b, [(a - b) * (a - b) for a, b in combinations(means, 2)])
    return F.sqrt((inside + between * F.lit(rows / len(means))) / F.lit(n - 1.0))


def extreme(name: str, n: int, pick) -> Column:
    parts = in_parts(name, n)
    return F.when(reduce(lambda a, b: a & b, [p.isNotNull() for p in parts]), pick(*parts))


def rolling_volatility(windows: Sequence[int] = VOL_WINDOWS) -> Columns:
    return {f"vol_{n}": deviation("_ret", n) for n in windows}


def return_lags(w: WindowSpec, lags: Sequence[int] = RETURN_LAGS) -> Columns:
    return {f"log_ret_lag{k}": F.lag("log_ret", k).over(w) for k in lags}


def volatility_lags(w: WindowSpec, windows: Sequence[int] = VOL_WINDOWS, lags: Sequence[int] = VOL_LAGS) -> Columns:
    return {f"vol_{n}_lag{k}": F.lag(f"vol_{n}", k).over(w) for n in windows for k in lags}


def absolute_return_means(windows: Sequence[int] = MEAN_WINDOWS) -> Columns:
    return {f"abs_ret_ma{n}": mean("_abs", n) for n in windows}


def bar_shape() -> Columns:
    return {
        "hl_range": ratio(F.col("high") - F.col("low"), "close"),
        "oc_change": ratio(F.col("close") - F.col("open"), "open"),
    }


def volume_change(w: WindowSpec) -> Columns:
    """Relative change of the last known volume (nulls are filled forward)."""
    before = F.lag("volume_ffill", 1).over(w)
    return {"vol_change": ratio("volume_ffill", before) - F.lit(1.0)}


def volume_level() -> Columns:
    level = mean("_volume", 10)
    return {"vol_ma_10": level, "vol_ratio_10": ratio(F.col("volume"), level)}


def range_means(windows: Sequence[int] = MEAN_WINDOWS) -> Columns:
    return {f"hl_range_ma{n}": mean("_range", n) for n in windows}


def cumulative_returns(windows: Sequence[int] = MEAN_WINDOWS) -> Columns:
    return {f"cum_ret_{n}": total("_ret", n) for n in windows}


def volatility_ratios() -> Columns:
    pairs = ((7, 14), (7, 21), (14, 28))
    return {f"vol_ratio_{a}_{b}": ratio(f"vol_{a}", f"vol_{b}") for a, b in pairs}


def price_step(w: WindowSpec) -> Columns:
    """Close-to-close change and true range, inputs of RSI and ATR."""
    before = F.lag("close", 1).over(w)
    return {
        "_delta": F.col("close") - before,
        "_true_range": F.greatest(
            F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before)
        ),
    }


def rsi(period: int = RSI_PERIOD) -> Columns:
    """Simple-mean RSI; null when the window has no loss."""
    return {f"rsi_{period}": F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + ratio(mean("_gain", period), mean("_loss", period)))}


def stochastic_k(period: int = STOCHASTIC_PERIOD) -> Columns:
    low, high = extreme("_low", period, F.least), extreme("_high", period, F.greatest)
    return {f"stoch_k_{period}": ratio((F.col("close") - low) * F.lit(100.0), high - low)}


def bollinger_bandwidth(period: int = BOLLINGER_PERIOD, width: float = BOLLINGER_WIDTH) -> Columns:
    level = total("_close_mean", period) / F.lit(float(period // SHORT))
    return {f"bb_bandwidth_{period}": ratio(F.lit(2.0 * width) * deviation("_close", period), level)}


def average_true_range(period: int = ATR_PERIOD) -> Columns:
    return {f"atr_{period}": mean("_tr", period)}


def calendar() -> Columns:
    day = F.col("date").cast("date")
    quarter_end = (day == F.last_day(day)) & F.month(day).isin(3, 6, 9, 12)
    return {
        "day_of_week": F.weekday(day),
        "month": F.month(day),
        "is_quarter_end": quarter_end.cast("int"),
    }


FAMILIES: dict[str, tuple[str, ...]] = {
    "return lags": tuple(f"log_ret_lag{k}" for k in RETURN_LAGS),
    "volatility lags": tuple(f"vol_{n}_lag{k}" for n in VOL_WINDOWS for k in VOL_LAGS),
    "absolute return means": tuple(f"abs_ret_ma{n}" for n in MEAN_WINDOWS),
    "bar shape and volume": ("hl_range", "oc_change", "vol_change", "vol_ratio_10"),
    "range means": tuple(f"hl_range_ma{n}" for n in MEAN_WINDOWS),
    "cumulative returns": tuple(f"cum_ret_{n}" for n in MEAN_WINDOWS),
    "volatility ratios": ("vol_ratio_7_14", "vol_ratio_7_21", "vol_ratio_14_28"),
    "momentum": (f"rsi_{RSI_PERIOD}", f"stoch_k_{STOCHASTIC_PERIOD}"),
    "bollinger": (f"bb_bandwidth_{BOLLINGER_PERIOD}",),
    "true range": (f"atr_{ATR_PERIOD}",),
    "calendar": ("day_of_week", "month", "is_quarter_end"),
}
FEATURES: tuple[str, ...] = tuple(c for family in FAMILIES.values() for c in family)
HELPERS = ("log_ret", *[f"vol_{n}" for n in VOL_WINDOWS], "vol_ma_10")

# Rows of history behind the longest chain: 21-row lag of a 28-return window.
HISTORY = max(VOL_WINDOWS) + max(VOL_LAGS)


def numbered(df: DataFrame) -> DataFrame:
    """Give the panel row numbers unless it already has them."""
    if {"row_idx", "n_rows", "volume_ffill"} <= set(df.columns):
        return df
    return with_row_index(df.drop("row_idx", "n_rows"), forward_fill=["volume"])


def feature_levels(w: WindowSpec) -> list[Columns]:
    return [
        {**log_returns(w), **bar_shape(), **price_step(w), **volume_change(w), **calendar()},
        {**part_statistics(w), **return_lags(w)},
        earlier_parts(w),
        {
            **rolling_volatility(),
            **absolute_return_means(),
            **volume_level(),
            **range_means(),
            **cumulative_returns(),
            **rsi(),
            **stochastic_k(),
            **bollinger_bandwidth(),
            **average_true_range(),
        },
        {**volatility_lags(w), **volatility_ratios()},
    ]


def tag_features(df: DataFrame) -> DataFrame:
    """Record role and family of each feature in the column metadata."""
    family_of = {c: name for name, columns in FAMILIES.items() for c in columns}
    return df.select(
        *[
            F.col(c).alias(c, metadata={"role": "feature", "family": family_of[c]}) if c in family_of else F.col(c)
            for c in df.columns
        ]
    )


def build_features(bars: DataFrame, columns: Sequence[str] | None = None, ahead: int = 0, extra=None) -> DataFrame:
    """All 59 features (plus returns and volatilities), or only ``columns``.

    ``extra(w)`` may add columns that look ``ahead`` rows into the future
    (the targets) to the same pass.
    """
    w = block_window()
    panel = blocked(numbered(bars), back=HISTORY, ahead=ahead)
    for level in feature_levels(w):
        panel = panel.withColumns(level)
    if extra is not None:
        panel = panel.withColumns(extra(w))
    helpers = [f"{c}_{k}" if k else c for c, (_, most) in PARTS.items() for k in range(most)]
    panel = without_halo(panel).drop("_delta", "_true_range", "volume_ffill", *helpers)
    if columns is not None:
        panel = panel.select("series_id", "date", *columns)
    return tag_features(panel)


def feature_columns(df: DataFrame) -> list[str]:
    """Feature names: by column metadata, else by name."""
    tagged = [f.name for f in df.schema.fields if f.metadata.get("role") == "feature"]
    return tagged or [c for c in df.columns if c in FEATURES]


def feature_families(df: DataFrame) -> DataFrame:
    """Table ``(family, feature)`` of the features present in ``df``."""
    names = set(feature_columns(df))
    rows = [(family, c) for family, columns in FAMILIES.items() for c in columns if c in names]
    return df.sparkSession.createDataFrame(rows, "family string, feature string")


def causality_audit(
    bars: DataFrame, fractions: Sequence[float] = (0.3, 0.6, 0.9), tolerance: float = 1e-9, build=None
) -> DataFrame:
    """Recompute the features on prefixes of each series and compare the last
    row of each prefix with the row of the full computation.

    Each prefix is a copy of the raw bars under its own id: rows are numbered and
    volumes filled anew on it, so whatever reaches past its end shows. ``build`` is
    the feature pass to audit, from bars to features."""
    names = [*FEATURES, *HELPERS]
    place = numbered(bars)
    known = [c for c in bars.columns if c not in ("row_idx", "n_rows", "volume_ffill")]
    last = F.floor(F.col("n_rows") * F.col("fraction"))
    copies = place.withColumn("fraction", F.explode(F.array(*[F.lit(float(f)) for f in (*fractions, 1.0)])))
    full = F.col("fraction") == 1.0
    cuts = F.array(*[F.floor(F.col("n_rows") * F.lit(float(f))) for f in fractions])
    copies = copies.where(full | (F.col("row_idx") <= last)).select(
        *[c for c in known if c != "series_id"],
        F.concat_ws("|", "series_id", F.col("fraction").cast("string")).alias("series_id"),
        F.col("series_id").alias("_series"),
        "fraction",
        F.col("row_idx").alias("_place"),
        F.when(full, F.array_contains(cuts, F.col("row_idx"))).otherwise(F.col("row_idx") == last).alias("_at_cut"),
    )
    at_cut = (build or build_features)(copies).where("_at_cut").withColumn("row_idx", F.col("_place"))
    from_full = [F.max(F.when(F.col("fraction") == 1.0, F.col(c))).alias(f"full_{c}") for c in names]
    from_prefix = [F.max(F.when(F.col("fraction") < 1.0, F.col(c))).alias(f"prefix_{c}") for c in names]
    pairs = at_cut.groupBy(F.col("_series").alias("series_id"), "row_idx").agg(
        F.min("fraction").alias("fraction"), *from_full, *from_prefix
    )
    differs = []
    for c in names:
        a, b = F.col(f"full_{c}"), F.col(f"prefix_{c}")
        near = F.abs(a - b) <= F.lit(tolerance) * F.greatest(F.abs(a), F.lit(1e-12))
        differs.append(F.when((a.isNull() & b.isNull()) | F.coalesce(near, F.lit(False)), 0).otherwise(1))
    total = F.aggregate(F.array(*differs), F.lit(0), lambda s, x: s + x)
    return pairs.select("series_id", "fraction", "row_idx", total.alias("n_different"))
