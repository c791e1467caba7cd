"""Close-pair counts, GARCH and ARIMA blocks, and neighbours against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltide.operators import econometric, neighbours, tests_of_fit


@pytest.mark.parametrize("rows", [2048, 40])
def test_close_counts_equal_all_pairs(spark, rows):
    rng = np.random.default_rng(8)
    data, want = [], {}
    for g, n in (("a", 700), ("b", 90), ("c", 3)):
        e = np.round(rng.normal(size=n), 2 if g == "b" else 9)
        eps = 1.5 * e.std(ddof=1)
        near = np.abs(e[:, None] - e[None, :]) < eps
        close = near
        for m in range(1, 4):
            size = n - m + 1
            if m > 1:
                close = close[:size, :size] & near[m - 1 :, m - 1 :][:size, :size]
            for i in range(n):
                want.setdefault((g, i), []).append(int(close[i].sum()) if i < size else 0)
        for i in range(n):
            data.append((g, i, float(eps), *[float(e[i + s]) if i + s < n else None for s in range(3)]))
    df = spark.createDataFrame(data, "g string, row_idx long, eps double, e0 double, e1 double, e2 double")
    got = {(r.g, r.row_idx): [r.close1, r.close2, r.close3] for r in tests_of_fit.close_counts(df, 3, "eps", ["g"], rows).collect()}
    assert got == want


def test_bds_is_the_same_in_small_buckets(spark):
    rng = np.random.default_rng(2)
    rows = [("s", m, int(i), 0.0, float(v)) for m in ("x", "y") for i, v in enumerate(rng.normal(size=600))]
    df = spark.createDataFrame(rows, "series_id string, model string, day int, y_true double, y_pred double").withColumn("date", F.date_add(F.lit("2001-01-01"), "day"))
    one, many = ({(r.model, r.dim): r.statistic for r in tests_of_fit.bds(df, bucket_rows=n).collect()} for n in (2048, 50))
    assert one.keys() == many.keys() and len(one) == 4
    assert all(abs(one[k] - many[k]) < 1e-9 for k in one)


def simulated(n, omega, alpha, beta, seed):
    rng, v, out = np.random.default_rng(seed), omega / (1 - alpha - beta), np.zeros(n)
    for t in range(n):
        out[t] = np.sqrt(v) * rng.normal()
        v = omega + alpha * out[t] ** 2 + beta * v
    return out / 100


def frame_of(spark, series):
    rows = [(k, int(i), float(v)) for k, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, day int, log_ret double").select("series_id", F.date_add(F.lit("1950-01-01"), "day").alias("date"), "log_ret")


def test_garch_likelihood_equals_the_recursion(spark, monkeypatch):
    monkeypatch.setattr(econometric, "BLOCK_ROWS", 300)
    series = {"a": simulated(1500, 0.05, 0.1, 0.85, 1), "b": simulated(200, 0.05, 0.1, 0.8, 2)}
    grid = [(1.0, 0.1, 0.8), (0.5, 0.02, 0.975), (2.0, 0.9, 0.0999), (1.0, 0.2, 0.0)]
    candidates = spark.createDataFrame([(k, *g) for k in series for g in grid], "series_id string, level double, alpha double, beta double")
    got = {(r.series_id, r.alpha): r for r in econometric.garch_likelihood(econometric.garch_blocks(frame_of(spark, series)), candidates).collect()}
    assert len(got) == 8
    for k, x in series.items():
        e = 100 * x - (100 * x).mean()
        for level, alpha, beta in grid:
            omega, v, nll = level * e.var(ddof=1) * (1 - alpha - beta), e.var(ddof=1), 0.0
            for value in e:
                nll += 0.5 * (np.log(2 * np.pi * v) + value**2 / v)
                v = omega + alpha * value**2 + beta * v
            r = got[k, alpha]
            assert abs(r.nll - nll) < 1e-6 * abs(nll) and abs(r.next_variance - v) < 1e-9 * v


def test_garch_finds_long_memory_and_large_alpha(spark):
    series = {"slow": simulated(9000, 0.0005, 0.004, 0.995, 5), "wild": simulated(6000, 0.2, 0.75, 0.15, 6)}
    got = {r.series_id: r for r in econometric.fit_garch(frame_of(spark, series)).collect()}
    assert got["slow"].beta > 0.98 and got["slow"].alpha < 0.02
    assert abs(got["wild"].alpha - 0.75) < 0.12 and abs(got["wild"].beta - 0.15) < 0.08


def test_arima_path_equals_the_loop(spark, monkeypatch):
    monkeypatch.setattr(econometric, "PATH_ROWS", 64)
    fits = [("a", 0.01, [0.5, -0.2, 0.1], [0.4], [0.3, -0.1, 0.2], [0.05, 0.0, 0.1], 10.0, 500), ("b", -0.02, [], [0.3, 0.2], [0.1, 0.0, 0.0], [0.2, -0.3, 0.1], 5.0, 64), ("c", 0.1, [1.0], [], [0.2, 0.0, 0.0], [0.0, 0.0, 0.0], 1.0, 1)]
    df = spark.createDataFrame(fits, "series_id string, const double, ar array<double>, ma array<double>, last_z array<double>, last_u array<double>, last_y double, n_steps long")
    got = {}
    for r in econometric.arima_path(df).collect():
        got.setdefault(r.series_id, {})[r.row_idx] = r.y_pred
    for k, const, ar, ma, z, u, level, n in fits:
        path = []
        for _ in range(n):
            change = const + sum(a * b for a, b in zip(ar, z)) + sum(a * b for a, b in zip(ma, u))
            z, u, level = [change, *z[:2]], [0.0, *u[:2]], level + change
            path.append(level)
        assert sorted(got[k]) == list(range(n))
        assert np.allclose([got[k][i] for i in range(n)], path, rtol=1e-9)


def test_hashed_neighbours_find_nearly_all(spark):
    """Clustered vectors: recall of the 11 nearest, and far fewer comparisons than all pairs."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(300, 12)) * 4
    x = centres[rng.integers(0, 300, 12_000)] + rng.normal(size=(12_000, 12)) * 0.4
    df = spark.createDataFrame([(f"{i:05d}", v.tolist(), float(i % 2)) for i, v in enumerate(x)], "id string, v array<double>, y double").repartition(4).cache()
    queries = df.where("id % 40 = 0")
    found = neighbours.lsh_neighbours(queries, df, 11).collect()
    got = {}
    for r in found:
        got.setdefault(int(r.qid), set()).add(int(r.tid))
    hits = 0
    for i in range(0, 12_000, 40):
        hits += len(got[i] & set(np.argsort(((x - x[i]) ** 2).sum(1), kind="stable")[:11].tolist()))
    assert hits >= 0.95 * 11 * 300
    plan = neighbours.plan_hashing(x[:4096], 12_000, 11)
    assert plan is not None and plan.met >= neighbours.RECALL


def test_hashing_is_not_planned_for_shapeless_data(spark):
    x = np.random.default_rng(1).normal(size=(600, 59))
    assert neighbours.plan_hashing(x, 600, 11) is None
    df = spark.createDataFrame([(str(i), v.tolist(), 0.0) for i, v in enumerate(x[:60])], "id string, v array<double>, y double")
    assert {(r.qid, r.tid) for r in neighbours.neighbour_join(df, df, 3, "lsh").collect()} == {(r.qid, r.tid) for r in neighbours.neighbour_join(df, df, 3).collect()}
    with pytest.raises(ValueError):
        neighbours.neighbour_join(df, df, 3, "other")
