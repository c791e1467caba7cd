"""Baselines, metrics, residual tests and forecast comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from voltide.catalog.inputs import (
    BASELINES, PREDS, SCORERS, SCORES, SPLIT, VOL, W, chi2_p_sql, clean_table, features_sql, normal_p_sql, predictions,
    r, rr, scores, tidy, volatility,
)
from voltide.catalog.registry import query
from voltide.functions import scalars
from voltide.operators import baselines, comparison, metrics, splits, tests_of_fit
from voltide.operators.features import build_features
from voltide.plans.resampling import ORDER_SQL, POISSON, draws_sql, hash_sql, poisson_edges
from voltide.session import scratch_path
from voltide.settings import SEED
from voltide.sources import tables
from voltide.sources.ticks import flag_bars

# --- baselines -------------------------------------------------------------------

HIST = f"""{SPLIT}, h0 AS (SELECT *, row_number() OVER {W} - 1 AS k, count(*) OVER (PARTITION BY series_id) AS m
  FROM split WHERE split <> 'test'),
fits AS (SELECT series_id, last(target_vol_7 ORDER BY k) AS naive, avg(target_vol_7) FILTER (WHERE k >= m - 21) AS rolling,
  sum(target_vol_7 * CASE WHEN k = 0 THEN 1.0 ELSE 0.06 END * pow(0.94::DOUBLE, m - 1 - k)) AS ewma FROM h0 GROUP BY 1)"""


def _fits(spark, d):
    table = splits.temporal_split(clean_table(spark, d))
    return splits.history(table), table.where(F.col("split") == "test")


def baseline_query(name: str, model: str, column: str):
    def run(spark, d):
        history, test = _fits(spark, d)
        out = baselines.baseline_forecasts(history, test, "target_vol_7").where(F.col("model") == model)
        return tidy(out, 8)

    query(
        name,
        f"""WITH {HIST} SELECT series_id, date, '{model}' AS model, {r('target_vol_7', 'y_true', 8)}, {r(column, 'y_pred', 8)}
        FROM split JOIN fits USING (series_id) WHERE split = 'test'""",
    )(run)


baseline_query("b1_naive", "Naive", "naive")
baseline_query("b2_rolling_mean", "Rolling Mean", "rolling")
baseline_query("b3_ewma", "EWMA", "ewma")


@query(
    "b6_walk_forward",
    f"""WITH {PREDS} SELECT v.series_id, v.date, {r('CASE WHEN v.i >= floor(v.n * 0.7) + 6 THEN w.naive END', '"Naive"', 8)},
    {r('CASE WHEN v.i >= floor(v.n * 0.7) + 6 THEN w.rolling END', '"Rolling Mean"', 8)},
    {r('CASE WHEN v.i >= floor(v.n * 0.7) + 6 THEN w.ewma END', '"EWMA"', 8)} FROM vol v JOIN wf w USING (series_id, date)""",
)
def _(spark, d):
    out = baselines.walk_forward(volatility(spark, d), "vol_7", horizon=7)
    return tidy(out.select("series_id", "date", *baselines.MODELS), 8)


SST = "sum((y_true - y_pred) * (y_true - y_pred)) / (var_pop(y_true) * count(*))"
REG = f"count(*) AS n, {r('sqrt(avg((y_true - y_pred) * (y_true - y_pred)))', 'rmse')}, {r('avg(abs(y_true - y_pred))', 'mae')}, {r(f'1 - {SST}', 'r2')}"


@query("b7_benchmark_table", f"WITH {PREDS} SELECT model, {REG} FROM preds GROUP BY 1")
def _(spark, d):
    return tidy(metrics.benchmark_table(predictions(spark, d)))


# --- prediction tables --------------------------------------------------------------


@query("s9_prediction_tables", f"WITH {PREDS} SELECT series_id, date, {rr(('y_true', 'y_pred'), 8)}, model FROM preds")
def _(spark, d):
    path = scratch_path(spark, "preds")
    tables.save_predictions(predictions(spark, d), path)
    wide = tables.predictions_wide(tables.load_predictions(spark, path), BASELINES)
    return tidy(tables.predictions_long(wide, BASELINES).withColumn("model", F.col("model").cast("string")), 8)


@query(
    "s10_metrics_store",
    f"""WITH {PREDS}, m AS (SELECT model, {REG} FROM preds GROUP BY 1)
    SELECT 'test' AS scope, model, 'rmse' AS metric, rmse AS value FROM m UNION ALL SELECT 'test', model, 'mae', mae FROM m
    UNION ALL SELECT 'test', model, 'r2', r2 FROM m""",
)
def _(spark, d):
    path = scratch_path(spark, "metrics")
    table = metrics.regression_metrics(predictions(spark, d))
    tables.save_metrics(tables.metrics_long(table, "test", ["rmse", "mae", "r2"]), path)
    return tidy(tables.load_metrics(spark, path))


@query(
    "p7_align_predictions",
    f"""WITH {PREDS} SELECT series_id, date, {r('max(y_true)', 'y_true', 8)},
    {", ".join(r(f"max(CASE WHEN model = '{m}' THEN y_pred END)", f'"{m}"', 8) for m in BASELINES)} FROM preds GROUP BY 1, 2""",
)
def _(spark, d):
    preds = predictions(spark, d)
    left = tables.predictions_wide(preds.where(F.col("model") != "EWMA"), ["Naive", "Rolling Mean"])
    right = tables.predictions_wide(preds.where(F.col("model") == "EWMA"), ["EWMA"])
    return tidy(splits.align_predictions(left, right), 8)


@query(
    "p7_complete_models",
    f"""WITH {PREDS}, holes AS (SELECT * FROM preds WHERE NOT (model = 'Naive' AND i % 50 = 0)),
    t AS (SELECT count(*) AS total FROM (SELECT DISTINCT series_id, date FROM holes)),
    ok AS (SELECT model FROM holes, t GROUP BY model, total HAVING count(*) = total)
    SELECT model, count(*) AS n FROM holes JOIN ok USING (model) GROUP BY 1""",
)
def _(spark, d):
    preds = baselines.walk_forward(volatility(spark, d), "vol_7", horizon=7).where(F.col("Naive").isNotNull())
    preds = preds.withColumn("Naive", F.when(F.pmod("row_idx", F.lit(50)) != 0, F.col("Naive")))
    wide = preds.select("series_id", "date", F.col("vol_7").alias("y_true"), *baselines.MODELS)
    whole = splits.complete_models(tables.predictions_long(wide, baselines.MODELS))
    return whole.groupBy("model").agg(F.count(F.lit(1)).alias("n"))


CATEGORY = "CASE WHEN model = 'EWMA' THEN 'Weighted' ELSE 'Benchmark' END"


def with_category(preds):
    return splits.consolidate(
        {
            "Benchmark": preds.where(F.col("model").isin("Naive", "Rolling Mean")),
            "Weighted": preds.where(F.col("model") == "EWMA"),
        }
    )


@query("p8_consolidate", f"WITH {PREDS} SELECT {CATEGORY} AS category, model, count(*) AS n FROM preds GROUP BY 1, 2")
def _(spark, d):
    return with_category(predictions(spark, d)).groupBy("category", "model").agg(F.count(F.lit(1)).alias("n"))


# --- metrics ---------------------------------------------------------------------------


@query("m1_m3_regression_metrics", f"WITH {PREDS} SELECT series_id, model, {REG} FROM preds GROUP BY 1, 2")
def _(spark, d):
    return tidy(metrics.regression_metrics(predictions(spark, d), ["series_id", "model"]))


CLS = """count(*) AS n, count(*) FILTER (WHERE y_true = 1 AND y_class = 1) AS tp, count(*) FILTER (WHERE y_true = 0 AND y_class = 1) AS fp,
  count(*) FILTER (WHERE y_true = 1 AND y_class = 0) AS fn, count(*) FILTER (WHERE y_true = 0 AND y_class = 0) AS tn"""


@query(
    "m4_classification_metrics",
    f"""WITH {SCORES}, c AS (SELECT model, {CLS} FROM scores GROUP BY 1) SELECT model, n, {r('(tp + tn) / n', 'accuracy')},
    {r('coalesce(tp / nullif(tp + fp, 0), 0)', 'precision')}, {r('coalesce(tp / nullif(tp + fn, 0), 0)', 'recall')},
    {r('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)', 'f1')} FROM c""",
)
def _(spark, d):
    return tidy(metrics.classification_metrics(scores(spark, d)))


AUC = """auc0 AS (SELECT model, y_score, count(*) FILTER (WHERE y_true = 1) AS p, count(*) FILTER (WHERE y_true = 0) AS q
  FROM scores GROUP BY 1, 2),
auc1 AS (SELECT *, sum(p) OVER a AS cp, sum(q) OVER a AS cq, sum(p) OVER m AS tp, sum(q) OVER m AS tq FROM auc0
  WINDOW a AS (PARTITION BY model ORDER BY y_score ROWS UNBOUNDED PRECEDING), m AS (PARTITION BY model))"""


@query(
    "m5_auc",
    f"""WITH {SCORES}, {AUC} SELECT model, max(tp)::BIGINT AS n_pos, max(tq)::BIGINT AS n_neg,
    {r('sum(p * (cq - q / 2.0)) / max(tp * tq)', 'auc')} FROM auc1 GROUP BY 1""",
)
def _(spark, d):
    return tidy(metrics.auc(scores(spark, d)))


@query(
    "m6_roc_curve",
    f"""WITH {SCORES}, {AUC} SELECT model, {r('y_score', 'threshold')}, {r('(tq - cq + q) / tq', 'fpr')},
    {r('(tp - cp + p) / tp', 'tpr')} FROM auc1 UNION ALL SELECT DISTINCT model, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM auc1""",
)
def _(spark, d):
    return tidy(metrics.roc_curve(scores(spark, d)))


@query("m7_confusion_matrix", f"WITH {SCORES}, c AS (SELECT model, {CLS} FROM scores GROUP BY 1) SELECT model, tn, fp, fn, tp FROM c")
def _(spark, d):
    return metrics.confusion_matrix(scores(spark, d))


@query(
    "m8_cv_summary",
    f"""WITH {PREDS}, f AS (SELECT model, i % 5 AS fold, sqrt(avg((y_true - y_pred) * (y_true - y_pred))) AS rmse,
      avg(abs(y_true - y_pred)) AS mae, 1 - {SST} AS r2 FROM preds GROUP BY 1, 2)
    SELECT model, {", ".join(r(f'avg({m})', f'{m}_mean') for m in ('rmse', 'mae', 'r2'))},
    {", ".join(r(f'stddev_pop({m})', f'{m}_std') for m in ('rmse', 'mae', 'r2'))} FROM f GROUP BY 1""",
)
def _(spark, d):
    wide = baselines.walk_forward(volatility(spark, d), "vol_7", horizon=7).where(F.col("Naive").isNotNull())
    wide = wide.select(
        "series_id", "date", F.pmod("row_idx", F.lit(5)).alias("fold"), F.col("vol_7").alias("y_true"), *baselines.MODELS
    )
    preds = wide.unpivot(["series_id", "date", "fold", "y_true"], list(baselines.MODELS), "model", "y_pred")
    return tidy(metrics.cv_summary(metrics.regression_metrics(preds, ["model", "fold"]), ["rmse", "mae", "r2"]))


HALF = "CASE WHEN date < DATE '2001-01-01' THEN 'train' ELSE 'test' END"


@query(
    "m9_overfit_gap",
    f"""WITH {PREDS}, h AS (SELECT *, {HALF} AS part FROM preds), m AS (SELECT model,
      1 - (sum((y_true - y_pred) ** 2) FILTER (WHERE part = 'train')) / (var_pop(y_true) FILTER (WHERE part = 'train') * count(*) FILTER (WHERE part = 'train')) AS a,
      1 - (sum((y_true - y_pred) ** 2) FILTER (WHERE part = 'test')) / (var_pop(y_true) FILTER (WHERE part = 'test') * count(*) FILTER (WHERE part = 'test')) AS b
      FROM h GROUP BY 1) SELECT model, {r('a', 'r2_train')}, {r('b', 'r2_test')}, {r('a - b', 'gap')} FROM m""",
)
def _(spark, d):
    preds = predictions(spark, d)
    part = F.when(F.col("date") < F.lit("2001-01-01").cast("date"), "train").otherwise("test")
    return tidy(metrics.overfit_gap(preds.withColumn("split", part)))


@query(
    "m10_residual_summary",
    f"""WITH {PREDS}, e AS (SELECT model, y_true - y_pred AS e FROM preds) SELECT model, {r('avg(e)', 'mean')}, {r('stddev_pop(e)', 'std')},
    {r('min(e)', '"min"')}, {r('max(e)', '"max"')}, {r('sqrt(avg(e * e))', 'rmse')}, {r('avg(abs(e))', 'mae')} FROM e GROUP BY 1""",
)
def _(spark, d):
    return tidy(metrics.residual_summary(predictions(spark, d)))


MET = f"met AS (SELECT {CATEGORY} AS category, model, {REG} FROM preds GROUP BY 1, 2)"


def _table(spark, d):
    return metrics.regression_metrics(with_category(predictions(spark, d)), ["category", "model"])


@query("m12_complexity_join", f"WITH {PREDS}, {MET} SELECT category, model, n, rmse, mae, r2, CASE WHEN model IN ('Naive', 'Rolling Mean', 'EWMA') THEN 0 ELSE 3 END AS complexity FROM met")
def _(spark, d):
    return tidy(metrics.with_complexity(_table(spark, d)))


@query("m13_best_of_group", f"WITH {PREDS}, {MET} SELECT category, arg_min(model, rmse) AS model, min(rmse) AS rmse FROM met GROUP BY 1")
def _(spark, d):
    return tidy(metrics.best_of_group(_table(spark, d)))


@query(
    "m14_improvement_report",
    f"""WITH {PREDS}, m AS (SELECT model, sqrt(avg((y_true - y_pred) ** 2)) AS rmse FROM preds GROUP BY 1),
    b AS (SELECT rmse AS base FROM m WHERE model = 'Naive')
    SELECT model, {r('rmse', 'rmse')}, {r('base - rmse', 'improvement')}, {r('(base - rmse) * 100 / base', 'improvement_pct')} FROM m, b""",
)
def _(spark, d):
    table = metrics.regression_metrics(predictions(spark, d)).select("model", "rmse")
    return tidy(metrics.improvement_report(table, "Naive"))


@query("m15_real_vs_predicted", f"WITH {PREDS}, m AS (SELECT model, {REG} FROM preds GROUP BY 1) SELECT series_id, date, model, {rr(('y_true', 'y_pred'))}, rmse, r2 FROM preds JOIN m USING (model)")
def _(spark, d):
    return tidy(metrics.real_vs_predicted(predictions(spark, d)))


# --- residual tests ---------------------------------------------------------------------

RES = f"{PREDS}, res AS (SELECT series_id, model, date, y_true - y_pred AS e, row_number() OVER (PARTITION BY series_id, model ORDER BY date) AS k FROM preds)"


def acf_sql(lags: int) -> str:
    pieces = ", ".join(f"sum((e - m) * (lag{k} - m)) / sum((e - m) ** 2) AS acf_{k}" for k in range(1, lags + 1))
    shifted = ", ".join(f"lag(e, {k}) OVER (PARTITION BY series_id, model ORDER BY k) AS lag{k}" for k in range(1, lags + 1))
    return f"""{RES}, lagged AS (SELECT *, avg(e) OVER (PARTITION BY series_id, model) AS m, {shifted} FROM res),
acf AS (SELECT series_id, model, count(*) AS n, {pieces} FROM lagged GROUP BY 1, 2)"""


def lb_sql(lags: int) -> str:
    stat = "n * (n + 2) * (" + " + ".join(f"acf_{k} ** 2 / (n - {k})" for k in range(1, lags + 1)) + ")"
    return f"{acf_sql(lags)}, lb AS (SELECT series_id, model, {lags} AS lags, {stat} AS s FROM acf)"


for _lags in (10, 20):
    query(
        f"v3_ljung_box_{_lags}",
        f"WITH {lb_sql(_lags)} SELECT series_id, model, lags, {r('s', 'statistic', 4)}, {r(chi2_p_sql('s', _lags), 'p_value', 4)} FROM lb",
    )(lambda spark, d, k=_lags: tidy(tests_of_fit.ljung_box(predictions(spark, d), k), 4))

JB = f"""{RES}, cm AS (SELECT *, avg(e) OVER (PARTITION BY series_id, model) AS m FROM res),
mom AS (SELECT series_id, model, count(*) AS n, avg((e - m) ** 2) AS m2, avg((e - m) ** 3) AS m3, avg((e - m) ** 4) AS m4 FROM cm GROUP BY 1, 2),
jb AS (SELECT series_id, model, n, m3 / pow(m2, 1.5) AS skew, m4 / (m2 * m2) AS kurtosis FROM mom),
jb1 AS (SELECT *, n / 6.0 * (skew ** 2 + (kurtosis - 3) ** 2 / 4) AS statistic FROM jb)"""


@query("v4_jarque_bera", f"WITH {JB} SELECT series_id, model, n, {rr(('skew', 'kurtosis', 'statistic'), 4)}, {r('exp(-statistic / 2)', 'p_value', 4)} FROM jb1")
def _(spark, d):
    return tidy(tests_of_fit.jarque_bera(predictions(spark, d)), 4)


@query(
    "v5_acf_points",
    f"WITH {acf_sql(20)} " + " UNION ALL ".join(f"SELECT series_id, model, {k} AS lag, {r(f'acf_{k}', 'acf')}, {r('1.96 / sqrt(n)', 'band')} FROM acf" for k in range(1, 21)),
)
def _(spark, d):
    return tidy(tests_of_fit.acf_points(predictions(spark, d), 20))


@query(
    "v5_qq_points",
    f"""WITH {RES}, o AS (SELECT series_id, model, e, row_number() OVER (PARTITION BY series_id, model ORDER BY e) AS place,
      count(*) OVER (PARTITION BY series_id, model) AS n FROM res)
    SELECT series_id, model, place, {r('e', 'sample')}, {r('(place - 0.5) / n', 'position')} FROM o""",
)
def _(spark, d):
    return tidy(tests_of_fit.qq_points(predictions(spark, d)).drop("theoretical"))


def _horner(x: str, coefficients) -> str:
    out = repr(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {x} + {c!r})"
    return out


_TAIL = f"({_horner('q', scalars.QUANTILE_C)} / {_horner('q', scalars.QUANTILE_D)})"


@query(
    "v5_qq_theoretical",
    f"""WITH {RES}, o AS (SELECT series_id, model, e, row_number() OVER (PARTITION BY series_id, model ORDER BY e) AS place,
      count(*) OVER (PARTITION BY series_id, model) AS n FROM res),
    pos AS (SELECT *, (place - 0.5) / n AS p FROM o), m AS (SELECT *, p - 0.5 AS m, least(p, 1 - p) AS near, sqrt(-2 * ln(least(p, 1 - p))) AS q FROM pos),
    t AS (SELECT *, CASE WHEN near >= {scalars.QUANTILE_TAIL} THEN m * {_horner('(m * m)', scalars.QUANTILE_A)} / {_horner('(m * m)', scalars.QUANTILE_B)}
      WHEN p < 0.5 THEN {_TAIL} ELSE -{_TAIL} END AS t FROM m)
    SELECT series_id, model, place, {r('e', 'sample')}, {r('p', 'position')}, {r('t', 'theoretical')} FROM t""",
)
def _(spark, d):
    return tidy(tests_of_fit.qq_points(predictions(spark, d)))


WHITE_COLUMNS = ("log_ret_lag1", "hl_range", "rsi_14", "stoch_k_14", "vol_ratio_7_14")


@query("v1_white")
def _(spark, d):
    feats = build_features(flag_bars(spark, d), columns=WHITE_COLUMNS)
    return tidy(tests_of_fit.white(predictions(spark, d), feats, WHITE_COLUMNS), 4)


BDS = f"""{RES}, emb AS (SELECT series_id, model, k, e AS e0, lead(e, 1) OVER o AS e1, lead(e, 2) OVER o AS e2,
    count(*) OVER g AS n, 1.5 * stddev_samp(e) OVER g AS eps FROM res
    WINDOW o AS (PARTITION BY series_id, model ORDER BY k), g AS (PARTITION BY series_id, model)),
near AS (SELECT a.series_id, a.model, a.n::DOUBLE AS n, a.k AS i, b.k AS j, abs(a.e0 - b.e0) < a.eps AS n0,
    coalesce(abs(a.e1 - b.e1) < a.eps, false) AS n1, coalesce(abs(a.e2 - b.e2) < a.eps, false) AS n2
  FROM emb a JOIN emb b ON a.series_id = b.series_id AND a.model = b.model),
rows_ AS (SELECT series_id, model, i, n, count(*) FILTER (WHERE n0) AS r, count(*) FILTER (WHERE n0 AND i < j) AS c1,
    count(*) FILTER (WHERE n0 AND n1 AND i < j) AS c2, count(*) FILTER (WHERE n0 AND n1 AND n2 AND i < j) AS c3,
    count(*) FILTER (WHERE n0 AND i < j AND i > 1 AND j > 1) AS t2, count(*) FILTER (WHERE n0 AND i < j AND i > 2 AND j > 2) AS t3
  FROM near GROUP BY 1, 2, 3, 4),
tot AS (SELECT series_id, model, n, sum(c1) / (n * (n - 1) / 2) AS c, (sum(r * r) - 3 * sum(r) + 2 * n) / (n * (n - 1) * (n - 2)) AS k,
    sum(c2) / ((n - 1) * (n - 2) / 2) AS c2, sum(c3) / ((n - 2) * (n - 3) / 2) AS c3,
    sum(t2) / ((n - 1) * (n - 2) / 2) AS t2, sum(t3) / ((n - 2) * (n - 3) / 2) AS t3 FROM rows_ GROUP BY 1, 2, 3),
z AS (SELECT series_id, model, 2 AS dim, sqrt(n - 1) * (c2 - t2 ** 2) / sqrt(4 * (k ** 2 + 2 * k * c ** 2 + c ** 4 - 4 * k * c ** 2)) AS s FROM tot
  UNION ALL SELECT series_id, model, 3, sqrt(n - 2) * (c3 - t3 ** 3) / sqrt(4 * (k ** 3 + 2 * (k ** 2 * c ** 2 + k * c ** 4) + 4 * c ** 6 - 9 * k * c ** 4)) FROM tot)"""


@query("v2_bds", f"WITH {BDS} SELECT series_id, model, dim, {r('s', 'statistic', 4)}, {r(normal_p_sql('s'), 'p_value', 4)} FROM z")
def _(spark, d):
    return tidy(tests_of_fit.bds(predictions(spark, d)), 4)


@query("v6_residual_diagnostics")
def _(spark, d):
    feats = build_features(flag_bars(spark, d), columns=WHITE_COLUMNS)
    return tidy(tests_of_fit.residual_diagnostics(predictions(spark, d), feats, WHITE_COLUMNS), 4)


# --- comparison --------------------------------------------------------------------------


@query(
    "v7_midrank",
    f"""WITH {SCORES} SELECT series_id, date, model, rank() OVER (PARTITION BY model ORDER BY y_score)
      + (count(*) OVER (PARTITION BY model, y_score) - 1) / 2.0 AS midrank FROM scores""",
)
def _(spark, d):
    return comparison.midranks(scores(spark, d), ["model"], "y_score").select("series_id", "date", "model", "midrank")


DELONG = f"""{SCORES}, {AUC},
comp AS (SELECT s.series_id, s.date, s.model, s.y_true, CASE WHEN s.y_true = 1 THEN (cq - q / 2.0) / tq ELSE 1 - (cp - p / 2.0) / tp END AS v
  FROM scores s JOIN auc1 USING (model, y_score)),
pairs AS (SELECT a.model AS model_a, b.model AS model_b, a.y_true, a.v - b.v AS d FROM comp a JOIN comp b USING (series_id, date) WHERE a.model < b.model),
side AS (SELECT model_a, model_b, avg(d) FILTER (WHERE y_true = 1) AS delta,
  var_samp(d) FILTER (WHERE y_true = 1) / count(*) FILTER (WHERE y_true = 1) + var_samp(d) FILTER (WHERE y_true = 0) / count(*) FILTER (WHERE y_true = 0) AS variance
  FROM pairs GROUP BY 1, 2),
dl AS (SELECT *, delta / sqrt(variance) AS z FROM side)"""
DELONG_OUT = f"{r('delta', 'delta_auc')}, {r('variance', 'variance', 10)}, {r('z', 'z', 5)}, {r(normal_p_sql('z'), 'p_value', 5)}"


def _delong_round(df):
    return df.withColumns(
        {
            "delta_auc": F.round("delta_auc", 6) + F.lit(0.0),
            "variance": F.round("variance", 10) + F.lit(0.0),
            "z": F.round("z", 5) + F.lit(0.0),
            "p_value": F.round("p_value", 5) + F.lit(0.0),
        }
    )


@query("v8_delong_pair", f"WITH {DELONG} SELECT model_a, model_b, {DELONG_OUT} FROM dl WHERE model_a = 'range' AND model_b = 'rsi'")
def _(spark, d):
    return _delong_round(comparison.delong_pair(scores(spark, d), "range", "rsi"))


@query(
    "v12_delong_matrix",
    f"""WITH {DELONG}, both_ AS (SELECT * FROM dl UNION ALL SELECT model_b, model_a, -delta, variance, -z FROM dl)
    SELECT model_a, model_b, {DELONG_OUT} FROM both_""",
)
def _(spark, d):
    return _delong_round(comparison.delong_matrix(scores(spark, d), SCORERS))


def dm_sql(h: int, loss: str) -> str:
    def of(p: str) -> str:
        return f"(y_true - {p}) ** 2" if loss == "mse" else f"abs(y_true - {p})"

    lagged = "".join(f", lag(d, {k}) OVER {W} AS l{k}" for k in range(1, h))
    cov = "".join(f" + {2 * (1 - k / h)!r} * covar_samp(CASE WHEN l{k} IS NOT NULL THEN d END, l{k})" for k in range(1, h))
    return f"""{PREDS}, d0 AS (SELECT series_id, date, {of('naive')} - {of('rolling')} AS d FROM wf WHERE i >= floor(n * 0.7) + 6),
d1 AS (SELECT *{lagged} FROM d0),
dm AS (SELECT series_id, count(*) AS n, avg(d) AS mean_d, (var_samp(d){cov}) / count(*) AS v FROM d1 GROUP BY 1),
dm1 AS (SELECT *, CASE WHEN v > 0 THEN mean_d / sqrt(v) ELSE 0 END AS dm_stat FROM dm)"""


for _h, _loss in ((1, "mse"), (7, "mse"), (7, "mae")):
    query(
        f"v10_dm_pair_h{_h}_{_loss}",
        f"WITH {dm_sql(_h, _loss)} SELECT series_id, n, {r('mean_d', 'mean_d')}, {r('dm_stat', 'dm_stat', 5)}, {r(normal_p_sql('dm_stat'), 'p_value', 5)} FROM dm1",
    )(
        lambda spark, d, h=_h, loss=_loss: tidy(
            comparison.diebold_mariano(predictions(spark, d), "Naive", "Rolling Mean", h=h, loss=loss), 6
        ).withColumns({"dm_stat": F.round("dm_stat", 5), "p_value": F.round("p_value", 5)})
    )

DMX = f"""{PREDS}, pr AS (SELECT a.model AS model_a, b.model AS model_b, (a.y_true - a.y_pred) ** 2 AS la, (b.y_true - b.y_pred) ** 2 AS lb
  FROM preds a JOIN preds b USING (series_id, date) WHERE a.model < b.model),
dmx AS (SELECT model_a, model_b, avg(la - lb) / sqrt(var_samp(la - lb) / count(*)) AS s, sqrt(avg(la)) - sqrt(avg(lb)) AS g FROM pr GROUP BY 1, 2)"""


@query(
    "v11_dm_matrix",
    f"""WITH {DMX}, both_ AS (SELECT * FROM dmx UNION ALL SELECT model_b, model_a, -s, -g FROM dmx)
    SELECT model_a, model_b, {r('s', 'dm_stat', 5)}, {r('g', 'diff_rmse', 5)}, {r(normal_p_sql('s'), 'p_value', 5)} FROM both_""",
)
def _(spark, d):
    return tidy(comparison.diebold_mariano_matrix(predictions(spark, d), BASELINES), 5)


@query(
    "v11_dm_p_value_matrix",
    f"""WITH {DMX}, both_ AS (SELECT model_a, model_b, s FROM dmx UNION ALL SELECT model_b, model_a, s FROM dmx)
    SELECT model_a, {", ".join(r(f"max(CASE WHEN model_b = '{m}' THEN {normal_p_sql('s')} END)", f'"{m}"', 5) for m in BASELINES)} FROM both_ GROUP BY 1""",
)
def _(spark, d):
    pairs = comparison.diebold_mariano_matrix(predictions(spark, d), BASELINES)
    return tidy(comparison.p_value_matrix(pairs, BASELINES), 5)


@query(
    "v13_bonferroni",
    f"""WITH {DMX}, p AS (SELECT {normal_p_sql('s')} AS p, count(*) OVER () AS n FROM dmx)
    SELECT CAST(0.05 AS DOUBLE) AS alpha_original, count(*) AS n_comparisons, {r('0.05 / count(*)', 'alpha_bonferroni')},
    count(*) FILTER (WHERE p < 0.05) AS n_significant_uncorrected, count(*) FILTER (WHERE p < 0.05 / n) AS n_significant_bonferroni FROM p""",
)
def _(spark, d):
    return tidy(comparison.bonferroni(comparison.diebold_mariano_matrix(predictions(spark, d), BASELINES)))


BOOT_ROWS = f"""{PREDS}, num AS (SELECT *, row_number() OVER (ORDER BY {ORDER_SQL}) - 1 AS idx, count(*) OVER () AS total
  FROM wf WHERE i >= floor(n * 0.7) + 6)"""
BOOT = f"""{BOOT_ROWS}, {draws_sql('num', 1000, SEED)},
boot AS (SELECT rep, sqrt(avg((y_true - naive) ** 2)) AS "Naive", sqrt(avg((y_true - rolling) ** 2)) AS "Rolling Mean",
  sqrt(avg((y_true - ewma) ** 2)) AS "EWMA" FROM draws JOIN num USING (idx) GROUP BY 1)"""


def ci_sql(m: str) -> str:
    return f"""SELECT '{m}' AS model, {r(f'avg("{m}")', 'mean')}, {r(f'median("{m}")', 'median')}, {r(f'quantile_cont("{m}", 0.025)', 'ci_lower')},
    {r(f'quantile_cont("{m}", 0.975)', 'ci_upper')}, count(*) AS n_boot, CAST(0.95 AS DOUBLE) AS ci_level FROM boot"""


CI = " UNION ALL ".join(ci_sql(m) for m in BASELINES)


@query("v9_bootstrap_ci", f"WITH {BOOT} {CI}")
def _(spark, d):
    return tidy(comparison.bootstrap_intervals(predictions(spark, d), BASELINES, metrics.RMSE))


_count = " + ".join(f"CASE WHEN u >= {e!r} THEN 1 ELSE 0 END" for e in poisson_edges())
POISSON_BOOT = f"""{BOOT_ROWS}, w0 AS (SELECT num.*, rep, {hash_sql(SEED, POISSON, 'rep', 'idx')} / 4294967296.0 AS u
  FROM num, generate_series(1, 1000) g(rep)), w1 AS (SELECT *, {_count} AS c FROM w0),
boot AS (SELECT rep, {", ".join(f'sqrt(sum(c * (y_true - {c}) ** 2) / sum(c)) AS "{m}"' for m, c in (("Naive", "naive"), ("Rolling Mean", "rolling"), ("EWMA", "ewma")))}
  FROM w1 GROUP BY 1)"""


@query("v9_bootstrap_ci_poisson", f"WITH {POISSON_BOOT} {CI}")
def _(spark, d):
    return tidy(comparison.bootstrap_intervals(predictions(spark, d), BASELINES, metrics.RMSE, method="poisson"))


@query(
    "m11_master_table",
    f"WITH {BOOT}, ci AS ({CI}), {MET} SELECT category, model, n, rmse, mae, r2, ci_lower, ci_upper FROM met JOIN ci USING (model)",
)
def _(spark, d):
    preds = predictions(spark, d)
    intervals = comparison.bootstrap_intervals(preds, BASELINES, metrics.RMSE)
    return tidy(metrics.master_table(with_category(preds), intervals))


V14 = f"""{SCORES}, wide AS (SELECT series_id, date, max(y_true) AS y_true, max(y_score) FILTER (WHERE model = 'rsi') AS a,
    max(y_score) FILTER (WHERE model = 'range') AS b FROM scores GROUP BY 1, 2),
num AS (SELECT *, row_number() OVER (ORDER BY {ORDER_SQL}) - 1 AS idx, count(*) OVER () AS total FROM wide),
{draws_sql('num', 2000, SEED)},
taken AS (SELECT rep, y_true, a, b FROM draws JOIN num USING (idx) UNION ALL SELECT 0, y_true, a, b FROM num),
long AS (SELECT rep, 'a' AS side, a AS s, y_true FROM taken UNION ALL SELECT rep, 'b', b, y_true FROM taken),
cnt AS (SELECT rep, side, s, count(*) FILTER (WHERE y_true = 1) AS p, count(*) FILTER (WHERE y_true = 0) AS q FROM long GROUP BY 1, 2, 3),
cum AS (SELECT *, sum(q) OVER (PARTITION BY rep, side ORDER BY s ROWS UNBOUNDED PRECEDING) AS cq FROM cnt),
areas AS (SELECT rep, side, sum(p * (cq - q / 2.0)) / (sum(p) * sum(q)) AS auc FROM cum GROUP BY 1, 2),
dd AS (SELECT rep, max(auc) FILTER (WHERE side = 'a') - max(auc) FILTER (WHERE side = 'b') AS d FROM areas GROUP BY 1),
z AS (SELECT max(d) FILTER (WHERE rep = 0) AS delta_auc, stddev_pop(d) FILTER (WHERE rep > 0) AS sd, count(*) FILTER (WHERE rep > 0) AS n_boot FROM dd)"""


@query(
    "v14_bootstrap_auc_difference",
    f"WITH {V14} SELECT {rr(('delta_auc', 'sd'), 5)}, n_boot, {r('delta_auc / sd', 'z', 5)}, {r(normal_p_sql('(delta_auc / sd)'), 'p_value', 5)} FROM z",
)
def _(spark, d):
    return tidy(comparison.bootstrap_auc_difference(scores(spark, d), "rsi", "range"), 5)
