"""Bootstrap weights and row offsets against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltide.operators import comparison, metrics
from voltide.plans import ranking
from voltide.plans import resampling as R


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(3)
    rows = [(f"s{k % 7}", int(k), float(rng.integers(0, 2)), float(rng.integers(0, 25)), float(rng.normal())) for k in range(900)]
    return spark.createDataFrame(rows, "series_id string, day int, y_true double, a double, b double").select("series_id", F.date_add(F.lit("2001-01-01"), "day").alias("date"), "y_true", "a", "b")


def drawn_weights(total, n_boot, seed, size):
    """Rows of all replicates, one draw at a time."""
    out = np.zeros((n_boot, total), int)
    one = lambda stream, rep, place: int(R.hash_of(seed, stream, np.array([rep]), np.array([place]))[0])
    for rep in range(1, n_boot + 1):
        buckets = [int((one(R.BUCKET_HIGH, rep, j) * 2097152 + (one(R.BUCKET_LOW, rep, j) >> 11)) / 2**53 * total) // size for j in range(total)]
        for b in set(buckets):
            for k in range(buckets.count(b)):
                out[rep - 1, b * size + one(R.ROW, rep, (b << R.PLACE_BITS) + k) % min(size, total - b * size)] += 1
    assert (out.sum(1) == total).all()
    return out


def in_order(panel):
    from hashlib import md5

    p = panel.toPandas()
    p["g"] = [md5(s.encode()).hexdigest()[:2] for s in p.series_id]
    return p.sort_values(["g", "series_id", "date"]).reset_index(drop=True)


def test_numbers_follow_hash_group_series_and_date(panel):
    got = R.numbered_rows(panel).toPandas().sort_values("idx")
    want = in_order(panel)
    assert got.idx.tolist() == list(range(900)) and (got.total == 900).all()
    assert got.b.tolist() == want.b.tolist()
    assert R.numbered_rows(panel.limit(0)).count() == 0


def test_no_window_over_all_rows(panel):
    """Every window of the numbering is partitioned."""
    plan = R.numbered_rows(panel)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and ", [], [" not in plan


@pytest.mark.parametrize("method", ["draws", "poisson"])
def test_sums_and_areas_equal_brute_force(spark, panel, monkeypatch, method):
    size = 100
    monkeypatch.setattr(R, "BUCKET_ROWS", size)
    monkeypatch.setattr(R, "CHUNK_DRAWS", 350)
    monkeypatch.setattr(ranking, "BUCKET_ROWS", 64)
    p, n_boot, seed = in_order(panel), 6, 11
    if method == "draws":
        w = drawn_weights(len(p), n_boot, seed, size)
    else:
        u = R.hash_of(seed, R.POISSON, np.arange(1, n_boot + 1)[:, None], np.arange(len(p))[None, :]) / 2.0**32
        w = np.searchsorted(R.poisson_edges(), u, "right")
    sums = R.weighted_sums(panel, {"t": F.col("a") * F.col("b")}, n_boot, seed, method).orderBy("rep").toPandas()
    assert sums.weight.tolist() == w.sum(1).tolist()
    assert np.allclose(sums.t, w @ (p.a * p.b).to_numpy(), rtol=1e-12)
    areas = {(r.side, r.rep): r.auc for r in R.replicate_aucs(panel, "y_true", ["a", "b"], n_boot, seed, method).collect()}
    assert len(areas) == 2 * (n_boot + 1)
    for side, s in enumerate((p.a.to_numpy(), p.b.to_numpy())):
        for rep, v in enumerate([np.ones(len(p), int), *w]):
            pos, neg = p.y_true.to_numpy() == 1, p.y_true.to_numpy() == 0
            wins = (s[pos][:, None] > s[neg][None, :]) + 0.5 * (s[pos][:, None] == s[neg][None, :])
            want = (v[pos][:, None] * v[neg][None, :] * wins).sum() / (v[pos].sum() * v[neg].sum())
            assert abs(areas[side, rep] - want) < 1e-12


def test_intervals_of_metrics(spark, panel):
    preds = panel.unpivot(["series_id", "date", "y_true"], ["a", "b"], "model", "y_pred")
    got = {r.model: r for r in comparison.bootstrap_intervals(preds, ["a", "b"], metrics.MAE, n_boot=50).collect()}
    p = panel.toPandas()
    for m in "ab":
        plain = (p.y_true - p[m]).abs().mean()
        assert got[m].ci_lower < plain < got[m].ci_upper and got[m].n_boot == 50
    for metric, plain in ((metrics.RMSE, np.sqrt(((p.y_true - p.b) ** 2).mean())), (metrics.R2, 1 - ((p.y_true - p.b) ** 2).sum() / ((p.y_true - p.y_true.mean()) ** 2).sum())):
        terms = metric.terms(F.col("y_true"), F.col("b"))
        row = panel.select(F.lit(1).alias("one"), *[t.alias(f"t{k}") for k, t in enumerate(terms)]).groupBy().sum()
        value = row.select(metric.value(F.col("sum(one)").cast("double"), [F.col(f"sum(t{k})") for k in range(len(terms))])).first()[0]
        assert abs(value - plain) < 1e-9
