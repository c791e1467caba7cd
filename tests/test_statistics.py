"""Statistics and models against plain NumPy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltide.operators import balance, baselines, comparison, econometric, metrics, models, neighbours, prep, tests_of_fit
from voltide.plans.ranking import column_quantiles, exact_quantiles


def long_preds(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    y = rng.normal(size=n)
    frames = []
    for m, noise in (("a", 0.5), ("b", 0.6), ("c", 0.9)):
        frames.append(pd.DataFrame({"series_id": "S", "date": pd.date_range("2001-01-01", periods=n).date, "model": m, "y_true": y, "y_pred": y + rng.normal(size=n) * noise}))
    pdf = pd.concat(frames)
    return pdf, spark.createDataFrame(pdf)


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 5000, p=[0.9, 0.1]), "v": np.round(rng.normal(size=5000), 2)})
    df = spark.createDataFrame(pdf)
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"q1": 0.25, "q9": 0.9}).collect()}
    for g, part in pdf.groupby("g"):
        assert got[g]["q1"] == pytest.approx(np.quantile(part["v"], 0.25))
        assert got[g]["q9"] == pytest.approx(np.quantile(part["v"], 0.9))
    big = spark.range(30_000).select((F.pmod(F.col("id") * 7919, F.lit(30_000)) / 7.0).alias("x"))
    row = column_quantiles(big, ["x"], {"m": 0.5, "q": 0.25}).first()
    want = np.arange(30_000) / 7.0
    assert row["m"] == pytest.approx(np.median(want)) and row["q"] == pytest.approx(np.quantile(want, 0.25))


def test_diebold_mariano(spark):
    pdf, df = long_preds(spark)
    wide = pdf.pivot(index="date", columns="model", values="y_pred")
    y = pdf[pdf["model"] == "a"].set_index("date")["y_true"]
    d = ((y - wide["a"]) ** 2 - (y - wide["b"]) ** 2).to_numpy()
    var = np.var(d, ddof=1) + 2 * sum((1 - k / 3) * np.cov(d[:-k], d[k:], ddof=1)[0, 1] for k in (1, 2))
    got = comparison.diebold_mariano(df, "a", "b", h=3).first()
    assert got["dm_stat"] == pytest.approx(d.mean() / np.sqrt(var / len(d)))
    same = comparison.diebold_mariano(df, "a", "a", h=1)
    matrix = {(r["model_a"], r["model_b"]): r for r in comparison.diebold_mariano_matrix(df, ["a", "b", "c"]).collect()}
    assert matrix["a", "b"]["dm_stat"] == pytest.approx(-matrix["b", "a"]["dm_stat"])
    assert same.first()["dm_stat"] == 0.0 and same.first()["p_value"] == 1.0
    with pytest.raises(ValueError):
        comparison.diebold_mariano(df, "a", "b", loss="huber")


def test_delong_with_ties_and_one_class(spark):
    rng = np.random.default_rng(5)
    n = 200
    y = rng.integers(0, 2, n)
    s = {"a": np.round(y * 0.3 + rng.random(n), 1), "b": np.round(y * 0.1 + rng.random(n), 1)}
    pdf = pd.concat([pd.DataFrame({"series_id": "S", "date": pd.date_range("2001-01-01", periods=n).date, "model": m, "y_true": y, "y_score": v}) for m, v in s.items()])
    comp = {}
    for m, v in s.items():
        p, q = v[y == 1], v[y == 0]
        win = (p[:, None] > q[None, :]) + 0.5 * (p[:, None] == q[None, :])
        comp[m] = (win.mean(), win.mean(axis=1), win.mean(axis=0))
    delta = comp["a"][0] - comp["b"][0]
    var = np.var(comp["a"][1] - comp["b"][1], ddof=1) / (y == 1).sum() + np.var(comp["a"][2] - comp["b"][2], ddof=1) / (y == 0).sum()
    df = spark.createDataFrame(pdf)
    got = comparison.delong_pair(df, "a", "b").first()
    assert got["delta_auc"] == pytest.approx(delta) and got["variance"] == pytest.approx(var)
    areas = {r["model"]: r["auc"] for r in metrics.auc(df).collect()}
    assert areas["a"] - areas["b"] == pytest.approx(delta)
    none = comparison.delong_pair(df.withColumn("y_true", F.lit(0)), "a", "b").first()
    assert (none["delta_auc"], none["p_value"], none["variance"]) == (0.0, 1.0, 0.0)


def test_white_matches_numpy(spark):
    pdf, df = long_preds(spark)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 2))
    feats = pd.DataFrame({"series_id": "S", "date": pd.date_range("2001-01-01", periods=300).date, "u": x[:, 0], "v": x[:, 1]})
    one = pdf[pdf["model"] == "a"]
    e2 = (one["y_true"] - one["y_pred"]).to_numpy() ** 2
    design = np.column_stack([np.ones(300), x, x[:, 0] ** 2, x[:, 0] * x[:, 1], x[:, 1] ** 2])
    fit = design @ np.linalg.lstsq(design, e2, rcond=None)[0]
    want = 300 * (1 - ((e2 - fit) ** 2).sum() / ((e2 - e2.mean()) ** 2).sum())
    got = tests_of_fit.white(df.where("model = 'a'"), spark.createDataFrame(feats), ["u", "v"]).first()
    assert got["statistic"] == pytest.approx(want, rel=1e-6) and got["n_terms"] == 6 and 0 <= got["p_value"] <= 1


def regression_rows(spark, n=400):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(n, 3)) * [1, 5, 0.1]
    y = x @ [0.5, -0.1, 2.0] + rng.normal(size=n) * 0.3
    pdf = pd.DataFrame(x, columns=["u", "v", "w"]).assign(y=y, series_id="S", date=pd.date_range("2001-01-01", periods=n).date)
    return pdf, spark.createDataFrame(pdf)


def test_linear_models_match_closed_forms(spark):
    pdf, df = regression_rows(spark)
    z = pdf[["u", "v", "w"]].to_numpy()
    z = (z - z.mean(0)) / z.std(0)
    y = pdf["y"].to_numpy() - pdf["y"].mean()
    want = z @ np.linalg.solve(z.T @ z + np.eye(3), z.T @ y) + pdf["y"].mean()
    fit = models.fit_model(df, ["u", "v", "w"], "y", models.ridge())
    got = fit.predict(df).orderBy("date").toPandas()["y_pred"]
    np.testing.assert_allclose(got, want, rtol=1e-8)

    def descend(l1, l2):
        w = np.zeros(3)
        for _ in range(3000):
            for j in range(3):
                rho = z[:, j] @ (y - z @ w + z[:, j] * w[j]) / len(y)
                w[j] = np.sign(rho) * max(abs(rho) - l1, 0) / (1.0 + l2)
        return w

    for model, l1, l2 in ((models.lasso(0.05), 0.05, 0.0), (models.elastic_net(0.05, 0.5), 0.025, 0.025)):
        fit = models.fit_model(df, ["u", "v", "w"], "y", model)
        np.testing.assert_allclose(fit.pipeline.stages[-1].coefficients.toArray(), descend(l1, l2), atol=1e-6)


def test_neighbours_are_exact(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(600, 4))
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(series_id="S", date=pd.date_range("2001-01-01", periods=600).date, y=x[:, 0])
    df = spark.createDataFrame(pdf)
    rows = neighbours.vectors(df, list("abcd"), "y")
    got = neighbours.nearest_neighbours(rows, rows, 5).groupBy("qid").agg(F.max("distance").alias("d"), F.count("*").alias("n")).toPandas()
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    want = np.sort(dist, axis=1)[:, 4]
    assert (got["n"] == 5).all()
    np.testing.assert_allclose(np.sort(got["d"]), np.sort(want), rtol=1e-9)


def test_smote_balances_and_adasyn_refuses_easy_data(spark):
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(150, 2)), rng.normal(size=(40, 2)) + 1])
    pdf = pd.DataFrame(x, columns=["u", "v"]).assign(t=[0] * 150 + [1] * 40, series_id="S", date=pd.date_range("2001-01-01", periods=190).date)
    df = spark.createDataFrame(pdf)
    out = balance.smote(df, ["u", "v"], "t")
    assert {r["t"]: r["count"] for r in out.groupBy("t").count().collect()} == {0: 150, 1: 150}
    assert balance.adasyn(df, ["u", "v"], "t").where("synthetic").count() > 0
    far = df.withColumn("u", F.col("u") + 1000 * F.col("t"))
    with pytest.raises(balance.BalancingError):
        balance.adasyn(far, ["u", "v"], "t")


def test_walk_forward_ewma_is_the_recursion(walk):
    pdf, df = walk
    got = baselines.walk_forward(df, "close", horizon=3, train_fraction=0.5).orderBy("date").toPandas()
    want = pdf["close"].ewm(alpha=0.06, adjust=False).mean().shift(3)
    assert got["EWMA"].iloc[:2502].isna().all()
    np.testing.assert_allclose(got["EWMA"].iloc[2502:], want.iloc[2502:], rtol=1e-10)
    np.testing.assert_allclose(got["Rolling Mean"].iloc[2502:], pdf["close"].rolling(21).mean().shift(3).iloc[2502:], rtol=1e-10)


def test_garch_recovers_parameters(spark):
    rng = np.random.default_rng(8)
    n, omega, alpha, beta = 4500, 0.05, 0.10, 0.85
    e, s2 = np.zeros(n), 1.0
    for t in range(n):
        e[t] = rng.normal() * np.sqrt(s2)
        s2 = omega + alpha * e[t] ** 2 + beta * s2
    pdf = pd.DataFrame({"series_id": "G", "date": pd.date_range("1990-01-01", periods=n).date, "log_ret": e / 100})
    fit = econometric.fit_garch(spark.createDataFrame(pdf)).first()
    assert abs(fit["alpha"] - alpha) < 0.04 and abs(fit["beta"] - beta) < 0.07


def test_median_fill_and_scale(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,), (None,)], "x double")
    p = prep.fit_prep(df, ["x"])
    assert p.median["x"] == 3.0
    got = [r["x"] for r in prep.apply_prep(df, p).collect()]
    filled = np.array([1, 2, 4, 10, 3.0])
    np.testing.assert_allclose(got, (filled - filled.mean()) / filled.std())


def test_h7_takes_the_full_number_of_resamples(monkeypatch):
    from voltide.catalog import model_queries
    from voltide.catalog.registry import QUERIES

    seen = []
    monkeypatch.setattr(model_queries, "predictions", lambda spark, d: None)
    monkeypatch.setattr(model_queries, "with_category", lambda preds: None)
    monkeypatch.setattr(model_queries.regimes, "compare_with_best", lambda preds, candidate, n_boot=1000: seen.append(n_boot))
    QUERIES["h7_compare_with_best"](None, None)
    assert seen == [1000]
