"""Sources, quality, candles, features, targets and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltide.catalog.inputs import (
    CLEAN, EVENT, FLAG, KNOWN, SPLIT, SUPP, W, clean_table, features_sql, r, rr, tidy,
)
from voltide.catalog.registry import query
from voltide.operators import candles, features, quality, splits, targets
from voltide.plans.layout import with_row_index
from voltide.session import scratch_path
from voltide.settings import SEED
from voltide.sources import bars as bar_files
from voltide.sources import manifest, tables
from voltide.sources.ticks import event_bars, flag_bars, supplier_bars

OHLCV = ("open", "high", "low", "close", "volume")
# Unit prices have up to seven decimals: eight digits never round a tie.
BARS_OUT = f"series_id, date, {rr(OHLCV, 8)}"

# --- the first end-to-end slice ------------------------------------------------


def flagship(spark, d):
    table = targets.features_and_targets(flag_bars(spark, d))
    return tidy(
        table.groupBy("series_id").agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg("target_class").alias("avg_class"),
            F.sum("vol_7").alias("sum_vol_7"),
            F.count("target_vol_7").alias("n_target"),
        )
    )


query(
    "a0_features_to_targets",
    f"""WITH {features_sql()} SELECT series_id, count(*) AS n_rows, {r('avg(target_class)', 'avg_class')},
    {r('sum(vol_7)', 'sum_vol_7')}, count(target_vol_7) AS n_target FROM feat GROUP BY 1""",
)(flagship)

# --- sources and sinks ---------------------------------------------------------


def raw_text(bars):
    """Bars as they look in raw files: text, odd header case, broken cells."""
    bad = F.pmod(F.col("volume").cast("long"), F.lit(17)) == 0
    text = {
        "Date": F.when(F.pmod(F.col("volume").cast("long"), F.lit(23)) == 0, "xx").otherwise(F.col("date").cast("string")),
        "OPEN": F.col("open").cast("string"),
        "High": F.col("high").cast("string"),
        " Low": F.col("low").cast("string"),
        "Close": F.when(bad, "abc").otherwise(F.col("close").cast("string")),
        "Volume": F.when(F.pmod(F.col("volume").cast("long"), F.lit(19)) == 0, "n/a").otherwise(F.col("volume").cast("string")),
        "OpenInt": F.lit("0"),
    }
    return bars.select("series_id", *[c.alias(n) for n, c in text.items()])


RAW_COLUMNS = ("Date", "OPEN", "High", " Low", "Close", "Volume", "OpenInt")
RAW = f"""{FLAG}, raw AS (
  SELECT series_id, CASE WHEN CAST(volume AS BIGINT) % 23 = 0 THEN NULL ELSE date END AS date, open, high, low,
    CASE WHEN CAST(volume AS BIGINT) % 17 = 0 THEN NULL ELSE close END AS close,
    CASE WHEN CAST(volume AS BIGINT) % 19 = 0 THEN NULL ELSE volume END AS volume
  FROM bars)"""
LOADED = f"{RAW}, loaded AS (SELECT * FROM raw WHERE date IS NOT NULL AND close IS NOT NULL)"


@query("s1_read_bars", f"WITH {LOADED} SELECT {BARS_OUT} FROM loaded")
def _(spark, d):
    path = scratch_path(spark, "raw-bars")
    raw_text(flag_bars(spark, d)).write.option("header", True).csv(path)
    return tidy(bar_files.read_bars(spark, path, series_from="column"), 8)


@query("s2_read_many_series", f"WITH {LOADED} SELECT series_id, count(*) AS n_rows, {r('sum(close)', 'close')} FROM loaded GROUP BY 1")
def _(spark, d):
    path = scratch_path(spark, "raw-folders")
    raw_text(flag_bars(spark, d)).write.partitionBy("series_id").option("header", True).csv(path)
    bars = bar_files.read_bars(spark, path, series_from="folder")
    return tidy(bars.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("close").alias("close")))


#: Files of two layouts; one file is empty, one lacks a needed column.
LAYOUTS = (RAW_COLUMNS, ("volume", "CLOSE", "date", "high", "Open", "low"))
BROKEN = {"empty": (b"", "empty file"), "short": (b"Date,Open,High\n2001-01-02,1,2\n", "missing columns: low, close")}


def named_files(spark, d):
    """The raw bars as files named by their series, in two layouts, and the
    broken files. Spark writes the rows; its part files only get their names."""
    raw = raw_text(flag_bars(spark, d))
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "named-files"))
    fs = target.getFileSystem(conf)
    fs.mkdirs(target)
    for k, layout in enumerate(LAYOUTS):
        names = {c.strip().lower(): c for c in raw.columns}
        columns = [F.col(f"`{names[c.strip().lower()]}`").alias(c) for c in layout]
        chosen = raw.where((F.col("series_id") == "N").cast("int") == k)
        written = scratch_path(spark, "layout")
        chosen.select("series_id", *columns).write.partitionBy("series_id").option("header", True).csv(written)
        for i, status in enumerate(fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{written}/series_id=*/part-*"))):
            series = status.getPath().getParent().getName().split("=", 1)[1]
            fs.rename(status.getPath(), jvm.org.apache.hadoop.fs.Path(target, f"{series}.{k}{i}.us.txt"))
    for name, (content, _) in BROKEN.items():
        out = fs.create(jvm.org.apache.hadoop.fs.Path(target, f"{name}.us.txt"))
        out.write(content)
        out.close()
    return f"{target}/*.txt"


@query(
    "s2_files_by_own_header",
    f"WITH {LOADED} SELECT lower(series_id) AS series_id, count(*) AS n_rows, {r('sum(open)', 'open')}, {r('sum(close)', 'close')}, {r('sum(volume)', 'volume')} FROM loaded GROUP BY 1",
)
def _(spark, d):
    bars = manifest.read_files(spark, named_files(spark, d))
    sums = [F.sum(c).alias(c) for c in ("open", "close", "volume")]
    return tidy(bars.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_rows"), *sums))


@query(
    "s2_file_manifest",
    f"""WITH {FLAG} SELECT DISTINCT lower(series_id) AS series_id, CASE WHEN series_id = 'N' THEN 6 ELSE 7 END AS n_columns,
      CAST(NULL AS VARCHAR) AS error FROM bars
    UNION ALL SELECT * FROM (VALUES ('empty', CAST(NULL AS INTEGER), '{BROKEN["empty"][1]}'), ('short', 3, '{BROKEN["short"][1]}'))""",
)
def _(spark, d):
    files = manifest.file_manifest(spark, named_files(spark, d))
    return files.select("series_id", F.when(F.col("header").isNotNull(), F.size("header")).alias("n_columns"), "error").distinct()


@query("s3_required_columns", f"WITH {FLAG} SELECT series_id, count(*) AS n_rows FROM bars GROUP BY 1")
def _(spark, d):
    bars = bar_files.require_columns(bar_files.normalize_names(flag_bars(spark, d)))
    return bars.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query("s4_tolerant_cast", f"WITH {RAW} SELECT {BARS_OUT} FROM raw")
def _(spark, d):
    raw = bar_files.normalize_names(raw_text(flag_bars(spark, d)))
    return tidy(bar_files.tolerant_types(raw).select("series_id", "date", *OHLCV), 8)


@query("s5_drop_unused", f"WITH {FLAG} SELECT {BARS_OUT} FROM bars")
def _(spark, d):
    return tidy(bar_files.drop_unused(flag_bars(spark, d).withColumn("openint", F.lit(0))), 8)


@query("s6_drop_incomplete", f"WITH {RAW} SELECT {BARS_OUT} FROM raw WHERE date IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL")
def _(spark, d):
    raw = bar_files.tolerant_types(bar_files.normalize_names(raw_text(flag_bars(spark, d))))
    return tidy(bar_files.drop_incomplete(raw, (*bar_files.REQUIRED, "volume")).select("series_id", "date", *OHLCV), 8)


@query("s7_period_filter", f"WITH {FLAG} SELECT {BARS_OUT} FROM bars WHERE date >= DATE '1998-01-01'")
def _(spark, d):
    return tidy(bar_files.since(flag_bars(spark, d), "1998-01-01"), 8)


@query("s8_processed_tables", f"WITH {SPLIT} SELECT series_id, date, {rr(('vol_7', 'target_vol_7'))}, split FROM split WHERE split = 'test'")
def _(spark, d):
    path = scratch_path(spark, "processed")
    table = splits.temporal_split(clean_table(spark, d))
    tables.save_processed(table.select("series_id", "date", "vol_7", "target_vol_7", "split"), path)
    return tidy(tables.load_processed(spark, path, "test").withColumn("split", F.col("split").cast("string")))


@query(
    "s13_sample_series",
    f"WITH {SUPP} SELECT series_id FROM (SELECT DISTINCT series_id FROM bars) "
    f"ORDER BY md5(concat_ws(',', series_id, '{SEED}')), series_id LIMIT 20",
)
def _(spark, d):
    return bar_files.sample_series(supplier_bars(spark, d), 20)


@query(
    "s14_multi_horizon_table",
    f"""WITH {features_sql()}, u AS (SELECT series_id, count(*) AS n_rows,
      count(*) FILTER (WHERE ok AND target_vol_7 IS NOT NULL) AS a, count(*) FILTER (WHERE ok AND target_vol_14 IS NOT NULL) AS b,
      count(*) FILTER (WHERE ok AND target_vol_21 IS NOT NULL) AS c
      FROM (SELECT *, ({KNOWN}) AS ok FROM feat) GROUP BY 1)
    SELECT series_id, n_rows, 'target_vol_7' AS target, a AS usable FROM u UNION ALL
    SELECT series_id, n_rows, 'target_vol_14', b FROM u UNION ALL SELECT series_id, n_rows, 'target_vol_21', c FROM u""",
)
def _(spark, d):
    table = targets.features_and_targets(flag_bars(spark, d))
    return tables.usable_rows(table, features.FEATURES, ["target_vol_7", "target_vol_14", "target_vol_21"])


# --- quality -------------------------------------------------------------------

QA = f"""{SUPP}, spans AS (
  SELECT series_id, count(*) AS n_rows, min(date) AS date_min, max(date) AS date_max, count(*) - count(DISTINCT date) AS dup,
    count(DISTINCT date) AS present, avg(volume) AS mean_volume,
    count(*) FILTER (WHERE high < low) AS n_high_lt_low,
    count(*) FILTER (WHERE high < greatest(open, close)) AS n_high_lt_open_close,
    count(*) FILTER (WHERE low > least(open, close)) AS n_low_gt_open_close,
    count(*) FILTER (WHERE volume < 0) AS n_negative_volume, count(*) FILTER (WHERE volume IS NULL) AS n_null_volume
  FROM bars GROUP BY 1),
calendar AS (
  SELECT series_id, CAST(unnest(generate_series(date_min, date_max, INTERVAL 1 DAY)) AS DATE) AS date FROM spans),
workdays AS (SELECT * FROM calendar WHERE isodow(date) < 6),
gaps AS (
  SELECT w.series_id, count(*) AS expected, count(*) FILTER (WHERE b.date IS NULL) AS missing
  FROM workdays w LEFT JOIN bars b USING (series_id, date) GROUP BY 1)"""
PCT = "coalesce(missing * 100.0 / nullif(expected, 0), 0)"


@query("q1_basic_qa", f"WITH {QA} SELECT series_id, n_rows, date_min, date_max FROM spans")
def _(spark, d):
    return quality.basic_qa(supplier_bars(spark, d))


@query(
    "q2_duplicate_dates",
    """SELECT CAST(l_suppkey AS VARCHAR) AS series_id, count(*) - count(DISTINCT CAST(l_shipdate AS DATE)) AS n_duplicates_date
    FROM lineitem GROUP BY 1""",
)
def _(spark, d):
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    ticks = lines.select(F.col("l_suppkey").cast("string").alias("series_id"), F.col("l_shipdate").cast("date").alias("date"))
    return quality.duplicate_dates(ticks)


@query(
    "q3_business_day_gaps",
    f"""WITH {QA} SELECT series_id, expected AS n_business_days_expected, present AS n_business_days_present,
    missing AS n_business_days_missing, {r(PCT, 'pct_business_days_missing')} FROM spans JOIN gaps USING (series_id)""",
)
def _(spark, d):
    return tidy(quality.business_day_gaps(supplier_bars(spark, d)))


@query(
    "q3_missing_business_days",
    f"WITH {QA} SELECT w.series_id, w.date FROM workdays w ANTI JOIN bars b ON w.series_id = b.series_id AND w.date = b.date",
)
def _(spark, d):
    return quality.missing_business_days(supplier_bars(spark, d))


@query("q4_ohlc_rules", f"WITH {QA} SELECT series_id, n_high_lt_low, n_high_lt_open_close, n_low_gt_open_close FROM spans")
def _(spark, d):
    return quality.ohlc_rules(supplier_bars(spark, d))


@query("q5_volume_rules", f"WITH {QA} SELECT series_id, n_negative_volume, n_null_volume FROM spans")
def _(spark, d):
    return quality.volume_rules(supplier_bars(spark, d))


@query(
    "q6_qa_report",
    f"""WITH {QA} SELECT series_id, n_rows, date_min, date_max, dup AS n_duplicates_date, n_high_lt_low, n_high_lt_open_close,
    n_low_gt_open_close, n_negative_volume, n_null_volume, missing AS n_business_days_missing,
    {r(PCT, 'pct_business_days_missing')}, CAST(NULL AS VARCHAR) AS error FROM spans JOIN gaps USING (series_id)""",
)
def _(spark, d):
    return tidy(quality.qa_report(supplier_bars(spark, d)))


@query(
    "q6_qa_report_of_files",
    f"""WITH {LOADED}
    SELECT lower(series_id) AS series_id, count(*) AS n_rows, min(date) AS date_min, max(date) AS date_max, count(*) FILTER (WHERE high < low) AS n_high_lt_low,
      count(*) FILTER (WHERE volume IS NULL) AS n_null_volume, CAST(NULL AS VARCHAR) AS error FROM loaded GROUP BY 1
    UNION ALL SELECT v.*  FROM (VALUES {", ".join(f"('{n}', CAST(NULL AS BIGINT), CAST(NULL AS DATE), CAST(NULL AS DATE), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), '{e}')" for n, (_, e) in BROKEN.items())}) v""",
)
def _(spark, d):
    report = manifest.qa_report_of_files(spark, named_files(spark, d))
    return report.select("series_id", "n_rows", "date_min", "date_max", "n_high_lt_low", "n_null_volume", "error")


@query(
    "q7_faulty_series",
    f"""WITH {QA} SELECT count(*) AS n_series, count(*) FILTER (
    WHERE n_high_lt_low > 0 OR n_high_lt_open_close > 0 OR n_low_gt_open_close > 0) AS n_faulty FROM spans""",
)
def _(spark, d):
    return quality.faulty_series(supplier_bars(spark, d))


@query(
    "q8_liquidity_ranking",
    f"""WITH {QA}, ranked AS (SELECT series_id, n_rows, mean_volume, {PCT} AS pct_business_days_missing,
      n_rows / 1000.0 - 0.2 * {PCT} + 0.1 * ln(1 + mean_volume) AS score
      FROM spans JOIN gaps USING (series_id) WHERE n_rows >= 500)
    SELECT series_id, n_rows, {rr(('mean_volume', 'pct_business_days_missing', 'score'))} FROM ranked
    ORDER BY ranked.score DESC, series_id LIMIT 15""",
)
def _(spark, d):
    return tidy(quality.liquidity_ranking(supplier_bars(spark, d), min_rows=500))


@query(
    "q9_describe",
    f"""WITH {SUPP}, long AS (SELECT 'open' AS "column", open AS v FROM bars UNION ALL SELECT 'close', close FROM bars
      UNION ALL SELECT 'volume', volume FROM bars)
    SELECT "column", count(v) AS "count", {r('avg(v)', 'mean')}, {r('stddev_samp(v)', 'std')}, {r('min(v)', '"min"')},
    {r('quantile_cont(v, 0.25)', 'p25')}, {r('quantile_cont(v, 0.5)', 'p50')}, {r('quantile_cont(v, 0.75)', 'p75')},
    {r('max(v)', '"max"')} FROM long GROUP BY 1""",
)
def _(spark, d):
    return tidy(quality.describe(supplier_bars(spark, d), ["open", "close", "volume"]))


@query(
    "q10_null_counts",
    f"""WITH {features_sql()} {' UNION ALL '.join(f"SELECT '{c}' AS 'column', count(*) - count({c}) AS n_null FROM feat" for c in features.FEATURES)}""",
)
def _(spark, d):
    return quality.null_counts(features.build_features(flag_bars(spark, d)), features.FEATURES)


@query(
    "q11_histogram",
    f"""WITH {SUPP}, lim AS (SELECT min(volume) AS lo, max(volume) AS hi FROM bars),
    b AS (SELECT CAST(least(floor((volume - lo) / ((hi - lo) / 60.0)), 59) AS INT) AS bin, lo, hi FROM bars, lim)
    SELECT k AS bin, {r('lo + k * ((hi - lo) / 60.0)', 'bin_from')}, {r('lo + (k + 1) * ((hi - lo) / 60.0)', 'bin_to')},
    (SELECT count(*) FROM b WHERE bin = k) AS n FROM lim, range(60) g(k)""",
)
def _(spark, d):
    return tidy(quality.histogram(supplier_bars(spark, d), "volume", 60))


# --- candles -------------------------------------------------------------------

CANDLE = """, c0 AS (
  SELECT *, abs(close - open) AS body, high - greatest(open, close) AS upper_wick, least(open, close) - low AS lower_wick,
    lag(open) OVER w AS po, lag(close) OVER w AS pc, row_number() OVER w - 1 AS row_idx
  FROM bars WINDOW w AS (PARTITION BY series_id ORDER BY date)),
c1 AS (SELECT *, body / nullif(high - low, 0) AS body_pct, upper_wick / nullif(high - low, 0) AS upper_wick_pct,
  lower_wick / nullif(high - low, 0) AS lower_wick_pct FROM c0),
candle AS (SELECT *, CAST(coalesce(body_pct <= 0.10, false) AS INT) AS pat_doji,
  CAST(coalesce(lower_wick_pct >= 0.60 AND upper_wick_pct <= 0.15 AND body_pct <= 0.30, false) AS INT) AS pat_hammer,
  CAST(coalesce(pc < po AND close > open AND open <= pc AND close >= po, false) AS INT) AS pat_engulf_bull,
  CAST(coalesce(pc > po AND close < open AND open >= pc AND close <= po, false) AS INT) AS pat_engulf_bear FROM c1)"""
SUPP_CANDLE, FLAG_CANDLE = SUPP + CANDLE, FLAG + CANDLE
SHAPE = ("body", "upper_wick", "lower_wick", "body_pct", "upper_wick_pct", "lower_wick_pct")


@query("c1_candle_anatomy", f"WITH {SUPP_CANDLE} SELECT series_id, date, {rr(SHAPE)} FROM candle")
def _(spark, d):
    return tidy(candles.anatomy(supplier_bars(spark, d)).select("series_id", "date", *SHAPE))


@query("c2_doji", f"WITH {SUPP_CANDLE} SELECT series_id, date, pat_doji FROM candle")
def _(spark, d):
    return candles.single_bar_patterns(supplier_bars(spark, d)).select("series_id", "date", "pat_doji")


@query("c3_hammer", f"WITH {SUPP_CANDLE} SELECT series_id, date, pat_hammer FROM candle")
def _(spark, d):
    return candles.single_bar_patterns(supplier_bars(spark, d)).select("series_id", "date", "pat_hammer")


@query("c4_engulfing", f"WITH {SUPP_CANDLE} SELECT series_id, date, pat_engulf_bull, pat_engulf_bear FROM candle")
def _(spark, d):
    out = candles.patterns(supplier_bars(spark, d))
    return out.select("series_id", "date", "pat_engulf_bull", "pat_engulf_bear")


def _freq(keys: str) -> str:
    parts = [
        f"SELECT {keys} '{p}' AS pattern, sum({p}) AS n, {r(f'avg({p}) * 100', 'pct')} FROM candle {'GROUP BY series_id' if keys else ''}"
        for p in quality.PATTERNS
    ]
    return " UNION ALL ".join(parts)


@query("q12_pattern_frequency", f"WITH {SUPP_CANDLE} {_freq('')}")
def _(spark, d):
    return tidy(quality.pattern_frequency(candles.patterns(supplier_bars(spark, d))))


@query("q12_pattern_frequency_by_series", f"WITH {FLAG_CANDLE} {_freq('series_id,')}")
def _(spark, d):
    return tidy(quality.pattern_frequency(candles.patterns(flag_bars(spark, d)), by_series=True))


@query(
    "q13_series_summary",
    f"""WITH {SUPP_CANDLE} SELECT series_id, count(*) AS n_rows, min(date) AS date_min, max(date) AS date_max,
    {', '.join(f'sum({p}) AS {p}' for p in quality.PATTERNS)} FROM candle GROUP BY 1""",
)
def _(spark, d):
    return quality.series_summary(candles.patterns(supplier_bars(spark, d)))


@query(
    "q14_class_balance",
    f"""WITH {SPLIT} SELECT split, count(*) FILTER (WHERE target_class = 0) AS n_0, count(*) FILTER (WHERE target_class = 1) AS n_1,
    {r('avg(target_class)', 'p_1')} FROM split GROUP BY 1""",
)
def _(spark, d):
    return tidy(quality.class_balance(splits.temporal_split(clean_table(spark, d))))


@query("q15_flagged_events", f"WITH {FLAG_CANDLE} SELECT series_id, date, {r("close", "close", 8)} FROM candle WHERE pat_doji = 1")
def _(spark, d):
    return tidy(quality.flagged_events(candles.single_bar_patterns(flag_bars(spark, d)), "pat_doji"), 8)


@query("q15_row_slice", f"WITH {FLAG_CANDLE} SELECT series_id, date, row_idx, {r('close', 'close')} FROM candle WHERE row_idx >= 100 AND row_idx < 130")
def _(spark, d):
    return tidy(quality.row_slice(with_row_index(flag_bars(spark, d)), 100, 130).select("series_id", "date", "row_idx", "close"))


# --- features ------------------------------------------------------------------


def feature_query(name: str, columns, build=flag_bars, sql: str | None = None):
    text = f"WITH {features_sql(sql or FLAG)} SELECT series_id, date, {rr(columns)} FROM feat"
    query(name, text)(lambda spark, d: tidy(features.build_features(build(spark, d), columns=columns)))


feature_query("f1_log_returns", ["log_ret"])
feature_query("f1_log_returns_suppliers", ["log_ret"], supplier_bars, SUPP)
feature_query("f2_rolling_volatility", ["vol_7", "vol_14", "vol_21", "vol_28"])
feature_query("f2_rolling_volatility_suppliers", ["vol_7", "vol_14", "vol_21", "vol_28"], supplier_bars, SUPP)
feature_query("f3_lag_features", [*features.FAMILIES["return lags"], *features.FAMILIES["volatility lags"]])
feature_query("f4_abs_return_means", list(features.FAMILIES["absolute return means"]))
feature_query("f5_ohlcv_derived", [*features.FAMILIES["bar shape and volume"], "vol_ma_10"])
feature_query("f5_ohlcv_derived_events", ["hl_range", "oc_change", "vol_change", "vol_ma_10", "vol_ratio_10"], event_bars, EVENT)
feature_query("f6_rolling_range", list(features.FAMILIES["range means"]))
feature_query("f7_cumulative_returns", list(features.FAMILIES["cumulative returns"]))
feature_query("f8_volatility_ratios", list(features.FAMILIES["volatility ratios"]))
feature_query("f9_rsi", ["rsi_14"])
feature_query("f10_stochastic_k", ["stoch_k_14"])
feature_query("f11_bollinger_bandwidth", ["bb_bandwidth_20"])
feature_query("f12_atr", ["atr_14"])
_whole = ", ".join(f"CAST({c} AS INT) AS {c}" for c in features.FAMILIES["calendar"])
query("f13_calendar", f"WITH {features_sql()} SELECT series_id, date, {_whole} FROM feat")(
    lambda spark, d: flag_bars(spark, d).withColumns(features.calendar()).select("series_id", "date", *features.FAMILIES["calendar"])
)
FLOATS = [c for c in features.FEATURES if c not in features.FAMILIES["calendar"]]


@query("f14_all_features", f"WITH {features_sql()} SELECT series_id, date, {rr(FLOATS)}, {_whole} FROM feat")
def _(spark, d):
    return tidy(features.build_features(flag_bars(spark, d), columns=[*FLOATS, *features.FAMILIES["calendar"]]))


@query("f14_all_features_suppliers", f"WITH {features_sql(SUPP)} SELECT series_id, count(*) AS n_rows, {', '.join(r(f'sum({c})', c, 4) for c in FLOATS)} FROM feat GROUP BY 1")
def _(spark, d):
    table = features.build_features(supplier_bars(spark, d))
    return tidy(table.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(c) for c in FLOATS]), 4)


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in rows)


@query(
    "f15_feature_list",
    f"""WITH {features_sql()}, n AS (SELECT * FROM (VALUES {_values([(c,) for c in features.FEATURES])}) t(feature))
    SELECT n.feature, c.n_rows FROM n, (SELECT count(*) AS n_rows FROM feat) c""",
)
def _(spark, d):
    table = features.build_features(flag_bars(spark, d))
    names = features.feature_columns(table)
    counts = table.agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.select(F.explode(F.array(*[F.lit(c) for c in names])).alias("feature"), "n_rows")


@query(
    "f16_feature_families",
    f"""WITH {features_sql()}, m AS (SELECT * FROM (VALUES {_values([(f, c) for f, cs in features.FAMILIES.items() for c in cs])}) t(family, feature)),
    k AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, count({c}) AS n_known FROM feat" for c in features.FEATURES)})
    SELECT family, feature, n_known FROM m JOIN k USING (feature)""",
)
def _(spark, d):
    table = features.build_features(flag_bars(spark, d))
    names = list(features.FEATURES)
    known = table.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "feature", "n_known")
    return features.feature_families(table).join(known, "feature").select("family", "feature", "n_known")


@query(
    "f17_causality_audit",
    f"""WITH {features_sql()}, cuts AS (SELECT unnest([0.3, 0.6, 0.9]) AS fraction)
    SELECT series_id, CAST(fraction AS DOUBLE) AS fraction, row_idx, 0 AS n_different FROM feat, cuts
    WHERE row_idx = floor(n_rows * CAST(fraction AS DOUBLE))""",
)
def _(spark, d):
    return features.causality_audit(flag_bars(spark, d))


# --- targets and splits ---------------------------------------------------------

TARGETS = ("target_vol_7", "target_vol_14", "target_vol_21")


@query("t1_regression_targets", f"WITH {features_sql()} SELECT series_id, date, {rr(TARGETS)} FROM feat")
def _(spark, d):
    vols = features.build_features(flag_bars(spark, d), columns=["row_idx", "n_rows", "vol_7", "vol_14", "vol_21"])
    return tidy(targets.add_regression_targets(vols).select("series_id", "date", *TARGETS))


@query("t2_class_target", f"WITH {features_sql(SUPP)} SELECT series_id, date, target_class FROM feat")
def _(spark, d):
    vols = features.build_features(supplier_bars(spark, d), columns=["row_idx", "n_rows", "vol_7"])
    return targets.add_class_target(vols).select("series_id", "date", "target_class")


BORDERS = f"""{SPLIT}, borders AS (SELECT series_id, quantile_cont(vol_21, 1.0 / 3) AS border_1, quantile_cont(vol_21, 2.0 / 3) AS border_2
  FROM split WHERE split = 'train' GROUP BY 1)"""


@query("t3_regime_borders", f"WITH {BORDERS} SELECT series_id, {rr(('border_1', 'border_2'))} FROM borders")
def _(spark, d):
    return tidy(targets.regime_borders(splits.temporal_split(clean_table(spark, d))))


@query(
    "t4_regime_label",
    f"""WITH {BORDERS} SELECT series_id, date, CASE WHEN vol_21 IS NULL THEN -1 WHEN vol_21 <= border_1 THEN 0
    WHEN vol_21 <= border_2 THEN 1 ELSE 2 END AS target_regime FROM split JOIN borders USING (series_id)""",
)
def _(spark, d):
    table = splits.temporal_split(clean_table(spark, d))
    return targets.add_regime_target(table).select("series_id", "date", "target_regime")


@query("t5_all_targets", f"WITH {features_sql()} SELECT series_id, date, {rr(TARGETS)}, target_class FROM feat")
def _(spark, d):
    vols = features.build_features(flag_bars(spark, d), columns=["row_idx", "n_rows", "vol_7", "vol_14", "vol_21"])
    return tidy(targets.add_all_targets(vols).select("series_id", "date", *TARGETS, "target_class"))


@query("p1_temporal_split", f"WITH {SPLIT} SELECT series_id, date, row_idx, split FROM split")
def _(spark, d):
    table = splits.assert_no_leakage(splits.temporal_split(clean_table(spark, d)))
    return table.select("series_id", "date", "row_idx", "split")


@query(
    "p2_temporal_split_75_25",
    f"WITH {CLEAN} SELECT series_id, date, CASE WHEN row_idx < floor(n_rows * 0.75) THEN 'train' ELSE 'test' END AS split FROM clean",
)
def _(spark, d):
    return splits.temporal_split_75_25(clean_table(spark, d)).select("series_id", "date", "split")


@query(
    "p3_expanding_folds",
    f"""WITH {CLEAN}, folds AS (SELECT *, CAST(unnest([0, 1, 2, 3, 4]) AS INT) AS fold, floor(n_rows / 6.0) AS ts FROM clean),
    used AS (SELECT *, CASE WHEN row_idx < n_rows - (5 - fold) * ts THEN 'train'
      WHEN row_idx < n_rows - (5 - fold) * ts + ts THEN 'test' END AS role FROM folds)
    SELECT series_id, fold, role, count(*) AS n_rows, min(date) AS date_min, max(date) AS date_max
    FROM used WHERE role IS NOT NULL GROUP BY 1, 2, 3""",
)
def _(spark, d):
    folds = splits.expanding_folds(splits.temporal_split(clean_table(spark, d)))
    return folds.groupBy("series_id", "fold", "role").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("date_min"), F.max("date").alias("date_max")
    )


@query("p4_split_summary", f"WITH {SPLIT} SELECT series_id, split, count(*) AS n_rows, min(date) AS date_min, max(date) AS date_max FROM split GROUP BY 1, 2")
def _(spark, d):
    return splits.split_summary(splits.temporal_split(clean_table(spark, d)))


@query("p5_history", f"WITH {SPLIT} SELECT series_id, date, {r('target_vol_7', 'target_vol_7')} FROM split WHERE split IN ('train', 'val')")
def _(spark, d):
    return tidy(splits.history(splits.temporal_split(clean_table(spark, d))).select("series_id", "date", "target_vol_7"))


@query(
    "p6_lookback_sequences",
    f"""WITH {SPLIT}, s AS (SELECT series_id, date, split, row_idx, list(vol_7) OVER w AS a, list(rsi_14) OVER w AS b FROM split
      WINDOW w AS (PARTITION BY series_id ORDER BY row_idx ROWS BETWEEN 21 PRECEDING AND 1 PRECEDING))
    SELECT series_id, date, len(a) AS n_steps, {r('a[1]', 'first_vol')}, {r('a[21]', 'last_vol')}, {r('list_sum(b)', 'sum_rsi', 4)}
    FROM s WHERE row_idx >= 21 AND split = 'test'""",
)
def _(spark, d):
    table = splits.temporal_split(clean_table(spark, d))
    seqs = splits.lookback_sequences(table, ["vol_7", "rsi_14"]).where(F.col("split") == "test")
    total = F.aggregate("sequence", F.lit(0.0), lambda acc, x: acc + F.get(x, 1))
    return tidy(
        seqs.select(
            "series_id",
            "date",
            F.size("sequence").cast("long").alias("n_steps"),
            F.get(F.get("sequence", 0), 0).alias("first_vol"),
            F.get(F.get("sequence", 20), 0).alias("last_vol"),
            F.round(total, 4).alias("sum_rsi"),
        )
    )
