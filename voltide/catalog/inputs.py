"""Inputs shared by the catalog: Spark tables and the same tables as SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltide.operators.baselines import walk_forward_predictions
from voltide.operators.features import FEATURES, build_features
from voltide.operators.targets import features_and_targets
from voltide.session import materialize, scratch_path
from voltide.sources.ticks import event_bars, flag_bars, supplier_bars

DIGITS = 6

_WRITTEN: dict[tuple, str] = {}


def once(name: str):
    """Write a shared input the first time a session asks for it; later
    queries of the session scan the written table."""

    def wrap(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            key = (spark.sparkContext.applicationId, sf_dir, name)
            if key not in _WRITTEN:
                path = scratch_path(spark, name)
                build(spark, sf_dir).write.parquet(path)
                _WRITTEN[key] = path
            return spark.read.parquet(_WRITTEN[key])

        return run

    return wrap


def tidy(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double so that two engines agree on the last digits."""
    return df.select(
        *[
            (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def r(expression: str, name: str, digits: int = DIGITS) -> str:
    return f"round({expression}, {digits}) + 0.0 AS {name}"


def rr(names: Sequence[str], digits: int = DIGITS) -> str:
    return ", ".join(r(n, n, digits) for n in names)


_ORDER = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


def bars_sql(key: str = "l_returnflag") -> str:
    price = "l_extendedprice / l_quantity"
    return f"""bars AS (
  SELECT CAST({key} AS VARCHAR) AS series_id, CAST(l_shipdate AS DATE) AS date,
    first({price} ORDER BY {_ORDER}) AS open, max({price}) AS high, min({price}) AS low,
    last({price} ORDER BY {_ORDER}) AS close, sum(l_quantity) AS volume
  FROM lineitem GROUP BY 1, 2)"""


FLAG, SUPP = bars_sql("l_returnflag"), bars_sql("l_suppkey")
EVENT = """bars AS (
  SELECT event_type AS series_id, date_trunc('hour', ts) AS date,
    first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
    last(value ORDER BY ts, event_id) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2)"""


def _roll(fn: str, col: str, n: int) -> str:
    frame = f"(PARTITION BY series_id ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({col}) OVER {frame} = {n} THEN {fn}({col}) OVER {frame} END"


W = "(PARTITION BY series_id ORDER BY date)"


def features_sql(bars: str = FLAG) -> str:
    """CTE chain ending in ``feat``: bars, helpers, the 59 features, targets."""
    lag_ret = ", ".join(f"lag(log_ret, {k}) OVER {W} AS log_ret_lag{k}" for k in (1, 2, 3, 5, 7, 10, 14, 21))
    lag_vol = ", ".join(
        f"lag(vol_{n}, {k}) OVER {W} AS vol_{n}_lag{k}" for n in (7, 14, 21, 28) for k in (1, 2, 3, 5, 7, 14, 21)
    )
    vols = ", ".join(f"{_roll('stddev_samp', 'log_ret', n)} AS vol_{n}" for n in (7, 14, 21, 28))
    means = ", ".join(
        f"{_roll(fn, col, n)} AS {name}{n}"
        for fn, col, name in (
            ("avg", "abs_ret", "abs_ret_ma"), ("avg", "hl_range", "hl_range_ma"), ("sum", "log_ret", "cum_ret_"),
        )
        for n in (5, 10, 20)
    )
    targets = ", ".join(f"lead(vol_{h}, {h}) OVER {W} AS target_vol_{h}" for h in (7, 14, 21))
    return f"""{bars},
f0 AS (
  SELECT *, row_number() OVER {W} - 1 AS row_idx, count(*) OVER (PARTITION BY series_id) AS n_rows,
    lag(close) OVER {W} AS prev_close,
    last_value(volume IGNORE NULLS) OVER (PARTITION BY series_id ORDER BY date ROWS UNBOUNDED PRECEDING) AS vfill
  FROM bars),
f1 AS (
  SELECT *, CASE WHEN close > 0 AND prev_close > 0 THEN ln(close) - ln(prev_close) END AS log_ret,
    (high - low) / nullif(close, 0) AS hl_range, (close - open) / nullif(open, 0) AS oc_change,
    vfill / nullif(lag(vfill) OVER {W}, 0) - 1 AS vol_change,
    coalesce(CASE WHEN close > prev_close THEN close - prev_close END, 0) AS gain,
    coalesce(CASE WHEN close < prev_close THEN prev_close - close END, 0) AS loss,
    greatest(high - low, coalesce(abs(high - prev_close), 0), coalesce(abs(low - prev_close), 0)) AS tr
  FROM f0),
f2 AS (SELECT *, abs(log_ret) AS abs_ret FROM f1),
f3 AS (
  SELECT *, {vols}, {means}, {lag_ret},
    {_roll('avg', 'volume', 10)} AS vol_ma_10,
    {_roll('avg', 'gain', 14)} AS g14, {_roll('avg', 'loss', 14)} AS l14,
    {_roll('min', 'low', 14)} AS lo14, {_roll('max', 'high', 14)} AS hi14,
    {_roll('avg', 'close', 20)} AS ma20, {_roll('stddev_samp', 'close', 20)} AS sd20,
    {_roll('avg', 'tr', 14)} AS atr_14
  FROM f2),
feat AS (
  SELECT *, {lag_vol}, {targets},
    volume / nullif(vol_ma_10, 0) AS vol_ratio_10,
    vol_7 / nullif(vol_14, 0) AS vol_ratio_7_14, vol_7 / nullif(vol_21, 0) AS vol_ratio_7_21,
    vol_14 / nullif(vol_28, 0) AS vol_ratio_14_28,
    100.0 - 100.0 / (1.0 + g14 / nullif(l14, 0)) AS rsi_14,
    (close - lo14) * 100.0 / nullif(hi14 - lo14, 0) AS stoch_k_14,
    4.0 * sd20 / nullif(ma20, 0) AS bb_bandwidth_20,
    isodow(CAST(date AS DATE)) - 1 AS day_of_week, month(CAST(date AS DATE)) AS month,
    CASE WHEN CAST(date AS DATE) = last_day(CAST(date AS DATE)) AND month(CAST(date AS DATE)) IN (3, 6, 9, 12)
      THEN 1 ELSE 0 END AS is_quarter_end,
    CASE WHEN lead(vol_7, 7) OVER {W} > vol_7 THEN 1 ELSE 0 END AS target_class
  FROM f3)"""


KNOWN = " AND ".join(f"{c} IS NOT NULL" for c in FEATURES)


@once("clean")
def clean_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with all features and the main target: the modelling table,
    written once because several steps read it."""
    # The bars are read twice; the ticks behind them only once.
    table = features_and_targets(materialize(flag_bars(spark, sf_dir), "flag-bars"))
    keep = ["series_id", "date", "log_ret", "vol_7", "vol_14", "vol_21", "vol_28", *FEATURES]
    keep += ["target_vol_7", "target_vol_14", "target_vol_21", "target_class"]
    return table.dropna(subset=[*FEATURES, "target_vol_7"]).select(*keep)


CLEAN = f"""{features_sql()},
clean AS (
  SELECT * REPLACE (row_number() OVER {W} - 1 AS row_idx, count(*) OVER (PARTITION BY series_id) AS n_rows)
  FROM feat WHERE {KNOWN} AND target_vol_7 IS NOT NULL)"""

SPLIT = f"""{CLEAN},
split AS (
  SELECT *, CASE WHEN row_idx < floor(n_rows * 0.7) THEN 'train'
    WHEN row_idx < floor(n_rows * 0.85) THEN 'val' ELSE 'test' END AS split
  FROM clean)"""


def volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_features(flag_bars(spark, sf_dir), columns=["vol_7"])


VOL = f"""{FLAG},
ret AS (SELECT *, ln(close) - ln(lag(close) OVER {W}) AS log_ret FROM bars),
vol0 AS (SELECT *, {_roll('stddev_samp', 'log_ret', 7)} AS vol_7 FROM ret),
vol AS (
  SELECT series_id, date, vol_7 AS y, row_number() OVER {W} - 1 AS i, count(*) OVER (PARTITION BY series_id) AS n
  FROM vol0 WHERE vol_7 IS NOT NULL)"""


@once("predictions")
def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Walk-forward forecasts of 7-day volatility by three baselines."""
    return walk_forward_predictions(volatility(spark, sf_dir), "vol_7", horizon=7)


BASELINES = ("EWMA", "Naive", "Rolling Mean")

_BACK = "PARTITION BY series_id ORDER BY date ROWS BETWEEN"
PREDS = f"""{VOL},
wf AS (
  SELECT series_id, date, i, n, y AS y_true,
    lag(y, 7) OVER {W} AS naive,
    avg(y) OVER ({_BACK} 27 PRECEDING AND 7 PRECEDING) AS rolling,
    pow(0.94::DOUBLE, i - 7) * sum(y * CASE WHEN i = 0 THEN 1.0 ELSE 0.06 END * pow(0.94::DOUBLE, -i))
      OVER ({_BACK} UNBOUNDED PRECEDING AND 7 PRECEDING) AS ewma
  FROM vol),
preds AS (
  SELECT series_id, date, i, n, y_true, m.model, m.y_pred FROM (
    SELECT *, unnest([{{'model': 'Naive', 'y_pred': naive}}, {{'model': 'Rolling Mean', 'y_pred': rolling}},
      {{'model': 'EWMA', 'y_pred': ewma}}]) AS m
    FROM wf WHERE i >= floor(n * 0.7) + 6))"""

SCORERS = ("range", "rsi", "term")


@once("scores")
def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three simple scores for 'volatility rises', with ties by rounding."""
    table = features_and_targets(flag_bars(spark, sf_dir)).where(
        F.col("target_vol_7").isNotNull() & F.col("vol_14").isNotNull() & F.col("rsi_14").isNotNull()
        & F.col("stoch_k_14").isNotNull()
    )
    made = {
        "range": F.col("stoch_k_14") / F.lit(100.0),
        "rsi": F.col("rsi_14") / F.lit(100.0),
        "term": F.col("vol_14") / (F.col("vol_7") + F.col("vol_14")),
    }
    rows = table.select(
        "series_id", "date", F.col("target_class").alias("y_true"), *[F.round(c, 2).alias(n) for n, c in made.items()]
    )
    long = rows.unpivot(["series_id", "date", "y_true"], list(SCORERS), "model", "y_score")
    return long.withColumn("y_class", (F.col("y_score") >= 0.5).cast("int"))


SCORES = f"""{features_sql()},
scores AS (
  SELECT series_id, date, target_class AS y_true, m.model, m.y_score,
    CASE WHEN m.y_score >= 0.5 THEN 1 ELSE 0 END AS y_class
  FROM (SELECT *, unnest([{{'model': 'range', 'y_score': round(stoch_k_14 / 100.0, 2)}},
      {{'model': 'rsi', 'y_score': round(rsi_14 / 100.0, 2)}},
      {{'model': 'term', 'y_score': round(vol_14 / (vol_7 + vol_14), 2)}}]) AS m
    FROM feat WHERE target_vol_7 IS NOT NULL AND vol_14 IS NOT NULL AND rsi_14 IS NOT NULL
      AND stoch_k_14 IS NOT NULL))"""


def normal_p_sql(z: str) -> str:
    """Two-sided normal p-value: 1 - erf(|z|/sqrt 2), erf by its power series
    with positive terms (accurate where the result is rounded)."""
    x = f"(abs({z}) / sqrt(2.0))"
    term = f"exp(k * ln(2.0 * {x} * {x} + 1e-300) - (lgamma(2.0 * k + 2) - k * ln(2.0) - lgamma(k + 1.0)))"
    series = f"list_sum(list_transform(range(0, 400), lambda k: {term}))"
    return (
        f"CASE WHEN abs({z}) > 8 THEN 0.0 ELSE "
        f"greatest(0.0, 1.0 - 2.0 / sqrt(pi()) * exp(-{x} * {x}) * {x} * {series}) END"
    )


def chi2_p_sql(stat: str, df: int) -> str:
    term = f"pow({stat} / 2.0, i) / gamma(i + 1.0)"
    return f"exp(-{stat} / 2.0) * list_sum(list_transform(range(0, {df // 2}), lambda i: {term}))"


Bars = {"flag": flag_bars, "supplier": supplier_bars, "event": event_bars}
