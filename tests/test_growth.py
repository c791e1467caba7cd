"""Steps whose work must not grow faster than their input."""

import re

import numpy as np
import pandas as pd

from voltide.catalog import inputs
from voltide.operators import features, quality


def test_describe_computes_its_input_once_and_is_exact(spark, monkeypatch):
    written = []
    plain = quality.materialize
    monkeypatch.setattr(quality, "materialize", lambda df, name: written.append(name) or plain(df, name))
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.normal(size=3001), "b": rng.integers(0, 9, 3001).astype(float), "c": None}).astype({"c": float})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double")
    got = quality.describe(df, ["a", "b", "c"]).toPandas().set_index("column")
    assert written == ["described"] and sorted(got.index) == ["a", "b"]
    for c in ("a", "b"):
        want = [3001, pdf[c].mean(), pdf[c].std(), pdf[c].min(), *np.quantile(pdf[c], [0.25, 0.5, 0.75]), pdf[c].max()]
        np.testing.assert_allclose(got.loc[c, list(quality.STATISTICS)].astype(float), want, rtol=1e-9)


def test_moving_frames_are_narrow(walk):
    pdf, df = walk
    plan = features.build_features(df)._jdf.queryExecution().optimizedPlan().toString()
    # Lags are frames of one row; a sum over a frame is added up anew for each row.
    frames = {int(n) for n in re.findall(r"RowFrame, -(\d+), currentrow", plan)}
    assert frames == {features.SHORT - 1, features.LONG - 1}


def test_wide_frames_of_parts_equal_pandas(walk, spark):
    pdf, _ = walk
    pdf = pdf.head(300).copy()
    pdf.loc[100, "close"] = np.nan
    pdf.loc[200:260, "close"] = 7.0
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "series_id string, date date, open double, high double, low double, close double, volume double")
    got = features.build_features(df).orderBy("date").toPandas()
    ret = np.log(pdf["close"]).diff()
    for n in (7, 14, 21, 28):
        np.testing.assert_allclose(got[f"vol_{n}"], ret.rolling(n).apply(lambda v: v.std(ddof=1), raw=False), rtol=1e-7, atol=1e-12)
    assert (got["vol_28"].iloc[229:261] == 0).all()
    for n in (5, 10, 20):
        np.testing.assert_allclose(got[f"abs_ret_ma{n}"], ret.abs().rolling(n).mean(), rtol=1e-7, atol=1e-12)


def test_ticks_of_the_modelling_table_are_read_once(spark, monkeypatch):
    written = []
    plain = inputs.materialize
    monkeypatch.setattr(inputs, "materialize", lambda df, name: written.append(name) or plain(df, name))
    monkeypatch.setattr(inputs, "_WRITTEN", {})
    assert inputs.clean_table(spark, "/root/testdata/sf0.001").count() > 0 and written == ["flag-bars"]
