"""Layout, features, targets, splits."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltide.operators import features, splits, targets
from voltide.operators.candles import patterns
from voltide.plans.layout import blocked, with_row_index


def test_row_index_and_halo_cover_every_row_once(walk):
    pdf, df = walk
    rows = with_row_index(df)
    got = rows.orderBy("date").select("row_idx", "n_rows").toPandas()
    assert (got["row_idx"] == np.arange(len(pdf))).all() and (got["n_rows"] == len(pdf)).all()
    cut = blocked(rows, back=49, ahead=21)
    largest = cut.groupBy("_block").count().agg(F.max("count")).first()[0]
    assert largest <= 2048 + 49 + 21
    assert cut.select("_block").distinct().count() == 3


def test_features_match_pandas_across_blocks(walk):
    pdf, df = walk
    got = features.build_features(df).orderBy("date").toPandas()
    ret = np.log(pdf["close"]).diff()
    vol = ret.rolling(28).std()
    delta = pdf["close"].diff()
    gain = delta.where(delta > 0, 0.0).rolling(14).mean()
    loss = (-delta.where(delta < 0, 0.0)).rolling(14).mean()
    before = pdf["close"].shift(1)
    tr = pd.concat([pdf["high"] - pdf["low"], (pdf["high"] - before).abs(), (pdf["low"] - before).abs()], axis=1).max(axis=1)
    want = {
        "vol_28_lag21": vol.shift(21),
        "cum_ret_20": ret.rolling(20).sum(),
        "rsi_14": 100 - 100 / (1 + gain / loss),
        "atr_14": tr.rolling(14).mean(),
        "bb_bandwidth_20": 4 * pdf["close"].rolling(20).std() / pdf["close"].rolling(20).mean(),
        "vol_change": pdf["volume"].pct_change(),
    }
    for name, values in want.items():
        np.testing.assert_allclose(got[name], values, rtol=1e-7, atol=1e-10, err_msg=name)
    assert len(features.feature_columns(features.build_features(df))) == 59


def test_no_infinite_feature_and_zero_volume(spark):
    days = pd.date_range("2000-01-01", periods=40).date
    pdf = pd.DataFrame({"series_id": "Z", "date": days, "open": 5.0, "high": 5.0, "low": 5.0, "close": 5.0, "volume": 0.0})
    got = features.build_features(spark.createDataFrame(pdf)).orderBy("date").toPandas()
    assert got["vol_change"].isna().all() and got["rsi_14"].isna().all() and got["stoch_k_14"].isna().all()
    assert got["vol_7"].iloc[10] == pytest.approx(0.0, abs=1e-12)
    numbers = got[list(features.FEATURES)].astype(float).to_numpy()
    assert not np.isinf(numbers).any()


def test_null_volume_is_filled_over_any_distance(spark):
    n = 4200
    volume = np.full(n, np.nan)
    volume[0], volume[-1] = 10.0, 15.0
    pdf = pd.DataFrame({"series_id": "N", "date": pd.date_range("1990-01-01", periods=n).date, "open": 1.0, "high": 2.0, "low": 1.0, "close": 1.5})
    df = spark.createDataFrame(pdf).join(
        spark.createDataFrame(pd.DataFrame({"date": pdf["date"].iloc[[0, -1]], "volume": [10.0, 15.0]})), "date", "left"
    )
    last = features.build_features(df, columns=["vol_change"]).orderBy(F.col("date").desc()).first()
    assert last["vol_change"] == pytest.approx(0.5)


def test_causality(bars):
    audit = features.causality_audit(bars).toPandas()
    assert len(audit) == 9 and (audit["n_different"] == 0).all()


def test_targets(walk):
    _, df = walk
    table = targets.features_and_targets(df).orderBy("date").toPandas()
    assert table["target_vol_7"].iloc[3000] == pytest.approx(table["vol_7"].iloc[3007])
    assert set(table["target_class"]) == {0, 1} and 0.3 < table["target_class"].mean() < 0.7
    assert (table["target_class"].tail(7) == 0).all()
    with pytest.raises(KeyError):
        targets.add_regression_targets(df)


def test_split_order_and_shares(walk, spark):
    _, df = walk
    table = splits.temporal_split(df)
    counts = {r["split"]: r for r in splits.split_summary(splits.assert_no_leakage(table)).collect()}
    assert counts["train"]["date_max"] < counts["val"]["date_min"] <= counts["val"]["date_max"] < counts["test"]["date_min"]
    assert [counts[s]["n_rows"] for s in ("train", "val", "test")] == [3500, 750, 750]
    same_day = df.limit(10).withColumn("date", F.lit("2000-01-01").cast("date"))
    with pytest.raises(splits.LeakageError):
        splits.assert_no_leakage(splits.temporal_split(same_day))


def test_folds_train_before_test(walk):
    _, df = walk
    folds = splits.expanding_folds(df, gap=7).groupBy("fold", "role").agg(F.min("row_idx").alias("lo"), F.max("row_idx").alias("hi"))
    ends = {(r["fold"], r["role"]): (r["lo"], r["hi"]) for r in folds.collect()}
    for f in range(5):
        assert ends[f, "train"][1] + 8 == ends[f, "test"][0]
        assert ends[f, "test"][1] - ends[f, "test"][0] + 1 == 5000 // 6


def test_engulfing_first_row_is_zero(walk):
    _, df = walk
    first = patterns(df).orderBy("date").first()
    assert first["pat_engulf_bull"] == 0 and first["pat_engulf_bear"] == 0


def test_same_result_for_any_partition_count(bars, spark):
    results = []
    for n in (1, 16):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(features.build_features(bars, columns=["vol_28_lag21", "rsi_14"]).orderBy("series_id", "date").toPandas())
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    pd.testing.assert_frame_equal(*results)


def test_windows_are_split_into_blocks(bars):
    plan = features.build_features(bars)._jdf.queryExecution().optimizedPlan().toString()
    assert "_block" in plan
    physical = features.build_features(bars)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in physical
