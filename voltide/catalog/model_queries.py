"""Preprocessing, models, balancing, regimes, search and explanation.

Registered queries use fewer boosting rounds and search trials than the
library defaults; they always read the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from voltide.catalog.compare_queries import with_category
from voltide.catalog.inputs import BASELINES, FLAG, PREDS, SPLIT, clean_table, once, predictions, r, rr, tidy
from voltide.catalog.registry import query
from voltide.operators import (
    balance, baselines, econometric, explain, linear_search, metrics, models, neighbours, prep, regimes, search, splits, targets,
)
from voltide.operators.features import FAMILIES, FEATURES
from voltide.session import materialize, scratch_path
from voltide.sources import tables

X = list(FEATURES)
TREES = 10
Y, CLASS = "target_vol_7", "target_class"


@once("split")
def split_table(spark, d):
    return splits.temporal_split(clean_table(spark, d))


def parts(spark, d):
    table = split_table(spark, d)
    return splits.history(table), table.where(F.col("split") == "test")


HIST = f"{SPLIT}, hist AS (SELECT * FROM split WHERE split <> 'test')"
ALL_NULLABLE = [c for c in X if c not in ("day_of_week", "month", "is_quarter_end")]

# --- preprocessing ----------------------------------------------------------------


@query(
    "r1_median_imputer",
    f"""WITH {HIST} {' UNION ALL '.join(f"SELECT '{c}' AS 'column', {r(f'median({c})', 'median')} FROM hist" for c in X)}""",
)
def _(spark, d):
    return tidy(prep.median_table(parts(spark, d)[0], X))


def scaled_sql(columns, digits: int = 6) -> str:
    body = ", ".join(r(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()", c, digits) for c in columns)
    return f"WITH {HIST} SELECT series_id, date, {body} FROM hist"


@query("r2_standard_scaler", scaled_sql(X))
def _(spark, d):
    history, _ = parts(spark, d)
    return tidy(prep.apply_prep(history, prep.fit_prep(history, X)).select("series_id", "date", *X))


@query("r6_class_weights", f"WITH {HIST} SELECT target_class, count(*) AS n_class, {r('(SELECT count(*) FROM hist) / (2.0 * count(*))', 'weight')} FROM hist GROUP BY 1")
def _(spark, d):
    return tidy(prep.class_weights(parts(spark, d)[0]))


@query(
    "r7_scale_pos_weight",
    f"""WITH {HIST}, c AS (SELECT count(*) FILTER (WHERE target_class = 0) AS n_neg, count(*) FILTER (WHERE target_class = 1) AS n_pos FROM hist)
    SELECT n_neg, n_pos, {r('n_neg / n_pos', 'scale_pos_weight')} FROM c""",
)
def _(spark, d):
    return tidy(prep.scale_pos_weight(parts(spark, d)[0]))


@query("r3_pipeline")
def _(spark, d):
    history, test = parts(spark, d)
    fitted = models.fit_model(history, X, Y, models.ridge())
    return fitted.predict(test)


# --- models --------------------------------------------------------------------------

RIDGE2 = f"""{SPLIT}, st AS (SELECT avg(vol_7_lag1) AS m1, stddev_pop(vol_7_lag1) AS s1, avg(rsi_14) AS m2, stddev_pop(rsi_14) AS s2,
    avg(target_vol_7) AS my, count(*) AS n FROM split WHERE split <> 'test'),
z AS (SELECT s.series_id, s.date, s.split, (vol_7_lag1 - m1) / s1 AS a, (rsi_14 - m2) / s2 AS b, target_vol_7 - my AS y, my, target_vol_7 FROM split s, st),
g AS (SELECT sum(a * a) + 1 AS aa, sum(a * b) AS ab, sum(b * b) + 1 AS bb, sum(a * y) AS ay, sum(b * y) AS byy FROM z WHERE split <> 'test'),
w AS (SELECT (bb * ay - ab * byy) / (aa * bb - ab * ab) AS w1, (aa * byy - ab * ay) / (aa * bb - ab * ab) AS w2 FROM g)"""


@query(
    "l1_ridge_closed_form",
    f"WITH {RIDGE2} SELECT series_id, date, {r('target_vol_7', 'y_true')}, {r('my + w1 * a + w2 * b', 'y_pred')} FROM z, w WHERE split = 'test'",
)
def _(spark, d):
    history, test = parts(spark, d)
    fitted = models.fit_model(history, ["vol_7_lag1", "rsi_14"], Y, models.ridge())
    return tidy(fitted.predict(test).select("series_id", "date", "y_true", "y_pred"))


def model_query(name: str, model: models.Model):
    def run(spark, d):
        label = Y if model.task == "regression" else CLASS
        preds, _ = models.fit_and_score(split_table(spark, d), X, label, [model])
        return models.score_table(preds, model.task, ["model", "split"])

    query(name)(run)


model_query("l1_ridge", models.ridge())
model_query("l2_lasso", models.lasso())
model_query("l3_elastic_net", models.elastic_net())
model_query("l5_decision_tree_regressor", models.decision_tree("regression"))
model_query("l5_decision_tree_classifier", models.decision_tree("classification"))
model_query("l6_random_forest_regressor", models.random_forest("regression", TREES))
model_query("l6_random_forest_classifier", models.random_forest("classification", TREES))
model_query("l7_svr", models.rbf_svr())
model_query("l7_svm", models.rbf_svm())
model_query("l8_boosting_regressor", models.boosting("regression", TREES))
model_query("l8_boosting_classifier", models.boosting("classification", TREES))
model_query("l9_logistic_l1", models.logistic("l1"))
model_query("l9_logistic_l2", models.logistic("l2"))
model_query("l10_naive_bayes_mllib", models.naive_bayes())
model_query("l11_boosted_variants", models.boosted_300(TREES))

KNN = f"""{SPLIT}, st AS (SELECT {", ".join(f"avg({c}) FILTER (WHERE split <> 'test') AS m{i}, stddev_pop({c}) FILTER (WHERE split <> 'test') AS s{i}" for i, c in enumerate(X))} FROM split),
z AS (SELECT s.series_id, s.date, s.split, s.target_vol_7, s.target_class, {", ".join(f"({c} - m{i}) / s{i} AS z{i}" for i, c in enumerate(X))} FROM split s, st),
near AS (SELECT q.series_id, q.date, q.target_vol_7 AS y, q.target_class AS yc, t.target_vol_7 AS ty, t.target_class AS tc,
    row_number() OVER (PARTITION BY q.series_id, q.date ORDER BY {" + ".join(f"(q.z{i} - t.z{i}) * (q.z{i} - t.z{i})" for i in range(len(X)))}) AS k
  FROM z q, z t WHERE q.split = 'test' AND t.split <> 'test')"""


def _knn(spark, d, label):
    history, test = parts(spark, d)
    fitted = prep.fit_prep(history, X)
    return neighbours.knn_predict(prep.apply_prep(history, fitted), prep.apply_prep(test, fitted), X, label)


@query("l4_knn_regressor", f"WITH {KNN} SELECT series_id, date, 'KNN' AS model, {r('max(y)', 'y_true')}, {r('avg(ty)', 'y_pred')} FROM near WHERE k <= 11 GROUP BY 1, 2")
def _(spark, d):
    return tidy(_knn(spark, d, Y))


@query("l4_knn_classifier", f"WITH {KNN} SELECT series_id, date, 'KNN' AS model, {r('max(yc)', 'y_true')}, {r('avg(tc)', 'y_pred')} FROM near WHERE k <= 11 GROUP BY 1, 2")
def _(spark, d):
    return tidy(_knn(spark, d, CLASS))


def _nb_log(k: int) -> str:
    terms = " ".join(f"- 0.5 * ln(2 * pi() * (v{k}_{c} + fl)) - ({c} - m{k}_{c}) ** 2 / (2 * (v{k}_{c} + fl))" for c in X)
    return f"ln(n{k} / (n0 + n1)) {terms}"


NB = f"""{SPLIT}, st AS (SELECT count(*) FILTER (WHERE target_class = 0) AS n0, count(*) FILTER (WHERE target_class = 1) AS n1,
    1e-9 * greatest({", ".join(f"var_pop({c})" for c in X)}) AS fl,
    {", ".join(f"avg({c}) FILTER (WHERE target_class = {k}) AS m{k}_{c}, var_pop({c}) FILTER (WHERE target_class = {k}) AS v{k}_{c}" for k in (0, 1) for c in X)}
  FROM split WHERE split <> 'test'),
ll AS (SELECT series_id, date, target_class, {_nb_log(0)} AS l0, {_nb_log(1)} AS l1 FROM split, st WHERE split = 'test')"""


@query(
    "l10_naive_bayes",
    f"WITH {NB} SELECT series_id, date, 'Naive Bayes' AS model, target_class AS y_true, {r('1 / (1 + exp(l0 - l1))', 'y_score')}, CASE WHEN l1 > l0 THEN 1 ELSE 0 END AS y_class FROM ll",
)
def _(spark, d):
    history, test = parts(spark, d)
    return tidy(models.gaussian_naive_bayes(history, test, X))


@query("l12_fit_and_score")
def _(spark, d):
    preds, _ = models.fit_and_score(split_table(spark, d), X, Y, [models.ridge(), models.lasso(), models.decision_tree("regression")])
    return metrics.overfit_gap(preds)


@query("l13_multi_horizon_ridge")
def _(spark, d):
    return models.multi_horizon_ridge(split_table(spark, d), X, (7, 14, 21))


@query(
    "s11_feature_list_store",
    "SELECT * FROM (VALUES " + ", ".join(f"('{f}', '{c}')" for f, cs in FAMILIES.items() for c in cs) + ") t(family, feature)",
)
def _(spark, d):
    path = scratch_path(spark, "features")
    from voltide.operators import features as f
    from voltide.sources.ticks import flag_bars

    f.build_features(flag_bars(spark, d)).write.parquet(path)
    table = spark.read.parquet(path)
    return f.feature_families(table)


@query("s12_model_store", f"WITH {SPLIT} SELECT count(*) AS n, CAST(0.0 AS DOUBLE) AS max_gap FROM split WHERE split = 'test'")
def _(spark, d):
    history, test = parts(spark, d)
    fitted = models.fit_model(history, X, Y, models.ridge())
    path = scratch_path(spark, "model")
    tables.save_model(fitted.pipeline, path)
    again = tables.load_model(path).transform(test)
    first = fitted.pipeline.transform(test).select("series_id", "date", F.col("prediction").alias("p"))
    gap = F.max(F.abs(F.col("p") - F.col("prediction"))).alias("max_gap")
    return again.join(first, ["series_id", "date"]).agg(F.count(F.lit(1)).alias("n"), gap)


@query("g1_time_series_cv")
def _(spark, d):
    folds = materialize(splits.expanding_folds(splits.history(split_table(spark, d)).drop("row_idx", "n_rows")))
    preds = models.cross_validate(folds, X, Y, [models.ridge(), models.elastic_net()])
    per_fold = metrics.regression_metrics(preds, ["model", "fold"])
    return metrics.cv_summary(per_fold, ["rmse", "mae", "r2"])


# --- balancing --------------------------------------------------------------------------


def _ready(spark, d):
    history, _ = parts(spark, d)
    return prep.apply_prep(history, prep.fit_prep(history, X))


@query("r4_smote")
def _(spark, d):
    return balance.smote(_ready(spark, d), X)


@query("r5_adasyn")
def _(spark, d):
    columns = [c for c in X if c != "rsi_14"]
    history, _ = parts(spark, d)
    rare = history.withColumn("overbought", (F.col("rsi_14") > 65).cast("int"))
    return balance.adasyn(prep.apply_prep(rare, prep.fit_prep(rare, columns)), columns, "overbought")


@query("r8_balancing_comparison")
def _(spark, d):
    return balance.compare_balancing(split_table(spark, d), X, [models.logistic("l2"), models.boosting("classification", TREES)], n_splits=0)


# --- econometric ---------------------------------------------------------------------------


@query("b4_arima")
def _(spark, d):
    return econometric.arima_forecasts(*parts(spark, d), Y)


@query("b5_garch")
def _(spark, d):
    return econometric.garch_forecasts(*parts(spark, d), Y)


GARCH_POINTS = ((1.0, 0.1, 0.8), (1.0, 0.02, 0.975), (0.5, 0.6, 0.3))


@query(
    "b5_garch_likelihood",
    f"""WITH RECURSIVE {HIST}, x AS (SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY date) AS t, 100 * log_ret AS x FROM hist WHERE log_ret IS NOT NULL),
    st AS (SELECT series_id, avg(x) AS mu, var_samp(x) AS s2, count(*) AS n FROM x GROUP BY 1),
    c AS (SELECT * FROM (VALUES {", ".join(f"({a}::DOUBLE, {b}::DOUBLE, {g}::DOUBLE)" for a, b, g in GARCH_POINTS)}) v(level, alpha, beta)),
    e AS (SELECT series_id, t, (x - mu) ** 2 AS e2, level, alpha, beta, level * s2 * (1 - alpha - beta) AS omega FROM x JOIN st USING (series_id), c),
    rec AS (SELECT series_id, level, alpha, beta, 1 AS t, s2 AS v FROM st, c
      UNION ALL SELECT rec.series_id, rec.level, rec.alpha, rec.beta, rec.t + 1, omega + rec.alpha * e2 + rec.beta * v
      FROM rec JOIN e ON e.series_id = rec.series_id AND e.t = rec.t AND e.level = rec.level AND e.alpha = rec.alpha AND e.beta = rec.beta)
    SELECT rec.series_id, rec.level, rec.alpha, rec.beta, {r('max(e.omega)', 'omega', 5)}, {r('sum(0.5 * (ln(2 * pi() * v) + e2 / v))', 'nll', 5)},
      {r('max(v) FILTER (WHERE rec.t = n + 1)', 'next_variance', 5)}
    FROM rec JOIN st ON st.series_id = rec.series_id
    LEFT JOIN e ON e.series_id = rec.series_id AND e.t = rec.t AND e.level = rec.level AND e.alpha = rec.alpha AND e.beta = rec.beta GROUP BY 1, 2, 3, 4""",
)
def _(spark, d):
    history, _ = parts(spark, d)
    points = spark.createDataFrame(GARCH_POINTS, "level double, alpha double, beta double")
    candidates = history.select("series_id").distinct().join(F.broadcast(points))
    return tidy(econometric.garch_likelihood(econometric.garch_blocks(history), candidates), 5)


@query(
    "b4_arima_path",
    f"""WITH RECURSIVE {HIST}, y AS (SELECT series_id, {Y} AS y, row_number() OVER (PARTITION BY series_id ORDER BY date DESC) AS k FROM hist WHERE {Y} IS NOT NULL),
    l AS (SELECT series_id, {", ".join(f"max(y) FILTER (WHERE k = {k}) AS y{k}" for k in range(1, 5))} FROM y GROUP BY 1),
    n AS (SELECT series_id, count(*) AS n FROM split WHERE split = 'test' GROUP BY 1),
    rec AS (SELECT series_id, n, CAST(0 AS BIGINT) AS t, y1 - y2 AS z1, y2 - y3 AS z2, y3 - y4 AS z3, (y1 - y2) / 10 AS u1, (y2 - y3) / 10 AS u2, y1 AS level FROM l JOIN n USING (series_id)
      UNION ALL SELECT series_id, n, t + 1, 0.00001 + 0.4 * z1 - 0.2 * z2 + 0.1 * z3 + 0.3 * u1 + 0.1 * u2, z1, z2, 0, u1,
        level + 0.00001 + 0.4 * z1 - 0.2 * z2 + 0.1 * z3 + 0.3 * u1 + 0.1 * u2 FROM rec WHERE t < n)
    SELECT series_id, t - 1 AS row_idx, {r('level', 'y_pred')} FROM rec WHERE t > 0""",
)
def _(spark, d):
    history, test = parts(spark, d)
    back = Window.partitionBy("series_id").orderBy(F.desc("date"))
    last = history.where(F.col(Y).isNotNull()).withColumn("k", F.row_number().over(back)).where("k <= 4")
    last = last.groupBy("series_id").agg(*[F.max(F.when(F.col("k") == k, F.col(Y))).alias(f"y{k}") for k in range(1, 5)])
    z = F.array(*[F.col(f"y{k}") - F.col(f"y{k + 1}") for k in range(1, 4)])
    numbers = lambda *v: F.array(*[F.lit(x) for x in v])
    fits = last.select(
        "series_id", F.lit(0.00001).alias("const"), numbers(0.4, -0.2, 0.1).alias("ar"), numbers(0.3, 0.1).alias("ma"),
        z.alias("last_z"), F.transform(z, lambda v: v / 10).alias("last_u"), F.col("y1").alias("last_y"),
    )
    steps = test.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_steps"))
    return tidy(econometric.arima_path(fits.join(steps, "series_id")))


# --- regimes --------------------------------------------------------------------------------


def _mixture(spark, d, **options):
    table = split_table(spark, d)
    return table, regimes.fit_regime_mixture(table, X, router_trees=TREES, **options)


@query("h1_h2_regime_mixture")
def _(spark, d):
    table, mixture = _mixture(spark, d)
    return mixture.predict(table.where(F.col("split") == "test"))


@query("h5_regime_probabilities")
def _(spark, d):
    table, mixture = _mixture(spark, d)
    out = mixture.regime_probabilities(table.where(F.col("split") == "test"))
    return out.select("series_id", "date", *[f"p_{k}" for k in mixture.regimes])


@query("h6_ablations")
def _(spark, d):
    table, mixture = _mixture(spark, d)
    test = table.where(F.col("split") == "test")
    two = regimes.fit_regime_mixture(table, X, router_trees=TREES, n_regimes=2)
    preds = regimes.ablations(mixture, test).unionByName(two.predict(test, name="Regime Mixture (2 regimes)"))
    return metrics.regression_metrics(preds)


FB = f"""{SPLIT}, borders AS (SELECT quantile_cont(vol_21, 1.0 / 3) AS b1, quantile_cont(vol_21, 2.0 / 3) AS b2 FROM split WHERE split = 'train'),
lab AS (SELECT *, CASE WHEN vol_21 IS NULL THEN -1 WHEN vol_21 <= b1 THEN 0 WHEN vol_21 <= b2 THEN 1 ELSE 2 END AS target_regime FROM split, borders)"""


@query(
    "h3_fallback_plan",
    f"WITH {FB} SELECT split, target_regime, count(*) AS n_rows, CASE WHEN count(*) < 350 THEN 1 ELSE 0 END AS uses_fallback FROM lab WHERE target_regime >= 0 GROUP BY 1, 2",
)
def _(spark, d):
    labelled = targets.add_regime_target(split_table(spark, d), keys=())
    return regimes.fallback_plan(labelled, 350, ["split"])


def _components(spark, d):
    wide = baselines.walk_forward(predictions_source(spark, d), "vol_7", horizon=7).where(F.col("Naive").isNotNull())
    total = F.col("Naive") + F.col("Rolling Mean") + F.col("EWMA")
    return wide.select(
        "series_id", "date", F.col("vol_7").alias("y_true"),
        *[(F.col(m) / total).alias(f"p_{i}") for i, m in enumerate(("Naive", "Rolling Mean", "EWMA"))],
        *[F.col(m).alias(f"f_{i}") for i, m in enumerate(("Naive", "Rolling Mean", "EWMA"))],
    )


def predictions_source(spark, d):
    from voltide.catalog.inputs import volatility

    return volatility(spark, d)


@query(
    "h4_mixture",
    f"""WITH {PREDS}, c AS (SELECT series_id, date, naive, rolling, ewma, naive + rolling + ewma AS s FROM wf WHERE i >= floor(n * 0.7) + 6)
    SELECT series_id, date, {r('(naive * naive + rolling * rolling + ewma * ewma) / s', 'soft')},
    {r('greatest(naive, rolling, ewma)', 'argmax')}, {r('s / 3', 'uniform')} FROM c""",
)
def _(spark, d):
    parts_ = _components(spark, d)
    p, f = [F.col(f"p_{i}") for i in range(3)], [F.col(f"f_{i}") for i in range(3)]
    return tidy(parts_.select("series_id", "date", *[regimes.mix(p, f, h).alias(h) for h in ("soft", "argmax", "uniform")]))


@query("h7_compare_with_best")
def _(spark, d):
    return regimes.compare_with_best(with_category(predictions(spark, d)), "EWMA")


# --- search ------------------------------------------------------------------------------------

SMALL_SPACE = {"depth": search.Range(2, 6, whole=True)}


def _cv(spark, d):
    folds = materialize(splits.expanding_folds(splits.history(split_table(spark, d)).drop("row_idx", "n_rows")))
    return search.CrossValidator(folds, X, Y, lambda depth: models.decision_tree("regression", depth))


@query("g2_grid_search")
def _(spark, d):
    cv = _cv(spark, d)
    search.grid_search(cv, {"depth": [2, 4]})
    return cv.trial_table()


@query("g3_random_search")
def _(spark, d):
    cv = _cv(spark, d)
    search.random_search(cv, SMALL_SPACE, n_iter=3)
    return cv.trial_table()


@query("g4_bayesian_search")
def _(spark, d):
    cv = _cv(spark, d)
    search.bayesian_search(cv, SMALL_SPACE, n_trials=4, startup=2, batch=2)
    return cv.trial_table()


@query("g5_genetic_search")
def _(spark, d):
    cv = _cv(spark, d)
    search.genetic_search(cv, SMALL_SPACE, population=2, generations=1)
    return cv.trial_table()


_MATRICES: dict[tuple, linear_search.LinearValidator] = {}


def _linear(spark, d):
    """Fold matrices, built by the first search of a session."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _MATRICES:
        folds = materialize(splits.expanding_folds(splits.history(split_table(spark, d)).drop("row_idx", "n_rows")))
        _MATRICES[key] = linear_search.LinearValidator(folds, X, Y)
    return _MATRICES[key].fresh()


@query("g2_grid_search_linear")
def _(spark, d):
    cv = _linear(spark, d)
    search.grid_search(cv, linear_search.LINEAR_GRID)
    return cv.trial_table()


@query("g3_random_search_linear")
def _(spark, d):
    cv = _linear(spark, d)
    search.random_search(cv, linear_search.LINEAR_SPACE)
    return cv.trial_table()


@query("g4_bayesian_search_linear")
def _(spark, d):
    cv = _linear(spark, d)
    search.bayesian_search(cv, linear_search.LINEAR_SPACE)
    return cv.trial_table()


@query("g5_genetic_search_linear")
def _(spark, d):
    cv = _linear(spark, d)
    search.genetic_search(cv, linear_search.LINEAR_SPACE)
    return cv.trial_table()


@query("g6_search_comparison")
def _(spark, d):
    """All four searches at full size against the untuned elastic net."""
    cv = _linear(spark, d)
    search.grid_search(cv, linear_search.LINEAR_GRID)
    for run in (search.random_search, search.bayesian_search, search.genetic_search):
        run(cv, linear_search.LINEAR_SPACE)
    return metrics.search_comparison(cv.trial_table(), cv.untuned())


TRIALS = f"""{FLAG}, trials AS (SELECT series_id AS method, CAST(row_number() OVER (PARTITION BY series_id ORDER BY date) - 1 AS INT) AS i,
  close AS rmse FROM bars)"""


@query(
    "g6_convergence",
    f"""WITH {TRIALS} SELECT method, i, {r('rmse', 'rmse', 8)}, {r('min(rmse) OVER w', 'best_rmse', 8)}, count(*) OVER w AS n_evaluations FROM trials
    WINDOW w AS (PARTITION BY method ORDER BY i ROWS UNBOUNDED PRECEDING)""",
)
def _(spark, d):
    from voltide.plans.layout import with_row_index
    from voltide.sources.ticks import flag_bars

    rows = with_row_index(flag_bars(spark, d))
    trials = rows.select(F.col("series_id").alias("method"), F.col("row_idx").cast("int").alias("i"), F.col("close").alias("rmse"))
    return tidy(metrics.convergence(trials), 8)


# --- explanation ----------------------------------------------------------------------------------


@query("i1_importance")
def _(spark, d):
    history, _ = parts(spark, d)
    return explain.importance(models.fit_model(history, X, Y, models.boosting("regression", TREES)), spark)


@query("i2_permutation_importance")
def _(spark, d):
    history, test = parts(spark, d)
    return explain.permutation_importance(models.fit_model(history, X, Y, models.ridge()), test)


@query("i3_local_explanation")
def _(spark, d):
    history, test = parts(spark, d)
    fitted = models.fit_model(history, X, Y, models.ridge())
    cases = explain.representative_cases(fitted.predict(test)).select("case", "series_id", "date")
    return explain.explain_locally(fitted, history, materialize(test.join(cases, ["series_id", "date"])))


_cases = [
    f"SELECT model, '{c}' AS 'case', series_id, date, {rr(('y_true', 'y_pred', 'abs_error'))} FROM o WHERE {w}"
    for c, w in (("best", "k = 1"), ("worst", "k = n"), ("median", "k = floor(n / 2.0) + 1"))
]


@query(
    "i4_representative_cases",
    f"""WITH {PREDS}, o AS (SELECT model, series_id, date, y_true, y_pred, abs(y_true - y_pred) AS abs_error,
      row_number() OVER (PARTITION BY model ORDER BY abs(y_true - y_pred), series_id, date) AS k, count(*) OVER (PARTITION BY model) AS n FROM preds)
    {' UNION ALL '.join(_cases)}""".replace("preds.", ""),
)
def _(spark, d):
    return tidy(explain.representative_cases(predictions(spark, d)))
