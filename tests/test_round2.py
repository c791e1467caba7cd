"""Exactness at every size, and checks that cannot be optimised away."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F


def ewma(values, decay):
    out = [values[0]]
    for v in values[1:]:
        out.append(decay * out[-1] + (1 - decay) * v)
    return np.array(out)


@pytest.mark.parametrize("decay", [0.5, 0.94, 0.99, 0.9995])
def test_walk_forward_ewma_is_exact_for_any_decay(spark, walk, decay):
    from voltide.operators.baselines import walk_forward

    pdf, df = walk
    got = walk_forward(df.select("series_id", "date", "close"), "close", horizon=3, decay=decay).where("EWMA IS NOT NULL").orderBy("date").select("EWMA").toPandas()["EWMA"]
    want = ewma(pdf["close"].to_numpy(), decay)[: -3][-len(got) :]
    assert len(got) == 5000 - (3500 + 2) and np.allclose(got, want, rtol=1e-11)


@pytest.mark.parametrize("n", [300, 19_000, 30_000])
def test_column_quantiles_are_exact_at_every_size(spark, n):
    from voltide.plans.ranking import column_quantiles

    rng = np.random.default_rng(n)
    pdf = pd.DataFrame({"id": np.arange(n), "dense": rng.normal(0, 1, n), "tied": rng.integers(0, 4, n).astype(float)})
    pdf["sparse"] = np.where(pdf["id"] < 202, pdf["id"] * 1.0, np.nan)
    df = spark.createDataFrame(pdf).withColumn("sparse", F.when(~F.isnan("sparse"), F.col("sparse"))).withColumn("nothing", F.lit(None).cast("double"))
    names = ["dense", "tied", "sparse", "nothing"]
    got = {r["column"]: r for r in column_quantiles(df, names, {"q1": 0.25, "q2": 0.5, "q3": 0.75}).collect()}
    assert set(got) == set(names) and got["nothing"]["q2"] is None
    for c in names[:3]:
        assert np.allclose([got[c][q] for q in ("q1", "q2", "q3")], pdf[c].dropna().quantile([0.25, 0.5, 0.75]), rtol=1e-12)


def test_align_predictions_checks_even_if_y_true_is_not_selected(spark):
    from voltide.operators.splits import align_predictions

    a = spark.createDataFrame([("A", "2020-01-01", 1.0, 2.0), ("A", "2020-01-02", 3.0, 2.0)], "series_id string, date string, y_true double, m1 double")
    same = a.drop("m1").withColumn("m2", F.lit(1.0))
    assert align_predictions(a, same).select("m1", "m2").count() == 2
    for other in (same.withColumn("y_true", F.col("y_true") + 1), same.limit(1), same.union(same.limit(1).withColumn("date", F.lit("2021-01-01")))):
        with pytest.raises(Exception, match="differ"):
            align_predictions(a, other).select("m1", "m2").collect()


def test_bars_are_read_by_header_name(spark, tmp_path):
    from voltide.sources.bars import read_bars

    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "aa.us.txt").write_text("Date,Close,Open,High, Low ,Volume\n2020-01-02,4,1,5,0.5,7\n12:30:00,1,1,1,1,1\n2020-01-03 10:00:00,4,1,5,0.5,\n")
    rows = read_bars(spark, str(tmp_path / "a")).orderBy("date").collect()
    assert [(r.series_id, str(r.date), r.open, r.high, r.low, r.close, r.volume) for r in rows] == [("aa", "2020-01-02", 1, 5, 0.5, 4, 7), ("aa", "2020-01-03", 1, 5, 0.5, 4, None)]
    (tmp_path / "a" / "bb.us.txt").write_text("Date,Open,High,Low,Close,Volume\n2020-01-02,1,5,0.5,4,7\n")
    with pytest.raises(Exception, match="(?i)header|read"):
        read_bars(spark, str(tmp_path / "a")).collect()


def test_histogram_roc_and_ljung_box(spark):
    from voltide.operators import metrics, quality, tests_of_fit

    h = quality.histogram(spark.createDataFrame([(0.0,), (0.1,), (10.0,)], "v double"), "v", 5).orderBy("bin").collect()
    assert [r.n for r in h] == [2, 0, 0, 0, 1]
    preds = spark.createDataFrame([("m", 1, 0.9), ("m", 0, 0.2), ("m", 1, 0.2)], "model string, y_true int, y_score double")
    curve = metrics.roc_curve(preds).orderBy("fpr", "tpr").collect()
    assert [(r.fpr, r.tpr) for r in curve] == [(0.0, 0.0), (0.0, 0.5), (1.0, 1.0)]
    rng = np.random.default_rng(1)
    e = pd.DataFrame({"series_id": "A", "date": pd.date_range("2020-01-01", periods=200).date, "model": "m", "y_true": rng.normal(0, 1, 200), "y_pred": 0.0})
    out = tests_of_fit.ljung_box(spark.createDataFrame(e), lags=5).collect()[0]
    assert 0 < out.p_value < 1


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_tied_neighbours_come_in_id_order(spark, parts):
    from voltide.operators.neighbours import nearest_neighbours

    train = spark.createDataFrame([(f"t{k:03d}", [float(k % 2)], float(k)) for k in range(200)], "id string, v array<double>, y double").repartition(parts)
    queries = spark.createDataFrame([("q0", [0.0], None), ("q1", [1.0], None)], "id string, v array<double>, y double")
    got = nearest_neighbours(queries, train, 5).orderBy("qid", "rank").collect()
    assert [r.tid for r in got] == [f"t{k:03d}" for k in (0, 2, 4, 6, 8)] + [f"t{k:03d}" for k in (1, 3, 5, 7, 9)]


def test_intraday_bars_are_cut_into_blocks(spark):
    from voltide.plans.layout import SPAN, with_row_index, with_span
    from voltide.settings import BLOCK_ROWS

    bars = spark.range(100_000).select(F.lit("A").alias("series_id"), F.timestamp_seconds(F.col("id") * 60 + 1_600_000_000).alias("date"), "id")
    spans = with_span(bars, ["series_id"], "date").groupBy(SPAN).count().agg(F.max("count"), F.count("*")).first()
    assert spans[0] <= BLOCK_ROWS and spans[1] <= 2 * 100_000 / BLOCK_ROWS + 2
    assert with_row_index(bars).where("row_idx <> id OR n_rows <> 100000").isEmpty()


def test_normal_quantile(spark):
    from statistics import NormalDist

    from voltide.functions.scalars import normal_quantile

    rows = spark.range(0, 1001).select((F.col("id") / 1000).alias("p")).withColumn("q", normal_quantile("p")).collect()
    assert rows[0].q is None and rows[-1].q is None
    assert all(abs(r.q - NormalDist().inv_cdf(r.p)) < 1e-8 for r in rows[1:-1])
