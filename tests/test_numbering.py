"""Spans by density and the prefix replay audit."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from voltide.operators import features
from voltide.plans.layout import SPAN, with_row_index, with_span
from voltide.settings import BLOCK_ROWS


def at(df):
    return df.withColumn("date", F.timestamp_seconds("s"))


def test_spans_follow_each_series_and_bursts_are_cut(spark):
    minutes = spark.range(20_000).selectExpr("'A' AS series_id", "id * 60 + 1600000000 AS s")
    pair = spark.createDataFrame([("B", 1_600_000_000), ("B", 1_600_000_001)], "series_id string, s long")
    hours = spark.range(5000).selectExpr("'C' AS series_id", "id * 3600 + 1600000000 AS s")
    burst = spark.range(9000).selectExpr("'D' AS series_id", "id + 1600000000 AS s").union(spark.range(300).selectExpr("'D'", "1600000000 + 86400 * (id + 1)"))
    bars = at(minutes.union(pair).union(hours).union(burst))
    spans = {}
    for r in with_span(bars, ["series_id"], "date").groupBy("series_id", SPAN).count().collect():
        spans.setdefault(r.series_id, []).append(r["count"])
    assert max(max(n) for n in spans.values()) <= BLOCK_ROWS
    assert len(spans["A"]) <= 21 and len(spans["B"]) <= 2 and len(spans["C"]) <= 6 and len(spans["D"]) <= 70
    numbered = with_row_index(bars)
    want = F.row_number().over(Window.partitionBy("series_id").orderBy("date")) - 1
    assert numbered.withColumn("want", want).where("want <> row_idx").isEmpty() and numbered.count() == 34_302
    assert with_row_index(bars.limit(0)).count() == 0
    assert with_row_index(bars.union(spark.createDataFrame([("E", None)], "series_id string, s long").withColumn("date", F.timestamp_seconds("s")))).count() == 34_302


def test_audit_reports_a_leak_in_the_filled_volume(spark):
    rng = np.random.default_rng(9)
    close = 50 * np.exp(np.cumsum(rng.normal(0, 0.01, 400)))
    rows = [("W", int(i), float(c), float(c * 1.01), float(c * 0.99), float(c), None if i in (120, 241, 360) else float(rng.integers(100, 900))) for i, c in enumerate(close)]
    bars = spark.createDataFrame(rows, "series_id string, day int, open double, high double, low double, close double, volume double")
    bars = bars.withColumn("date", F.date_add(F.lit("2001-01-01"), "day")).drop("day")
    assert features.causality_audit(bars).where("n_different > 0").isEmpty()

    def leaky(copies):
        later = Window.partitionBy("series_id").orderBy("date").rowsBetween(0, Window.unboundedFollowing)
        rows = with_row_index(copies).withColumn("volume_ffill", F.coalesce(F.first("volume", ignorenulls=True).over(later), F.lit(1.0)))
        return features.build_features(rows)

    found = features.causality_audit(bars, build=leaky).orderBy("fraction").collect()
    assert [r.n_different > 0 for r in found] == [True, False, True]


def test_balancing_table_has_folds_and_errors(spark):
    from voltide.operators import balance, models

    rng = np.random.default_rng(6)
    rows = []
    for i in range(360):
        x = rng.normal(size=3)
        rows.append(("W", i, *map(float, x), int(x[0] + 0.5 * rng.normal() > 0.6)))
    df = spark.createDataFrame(rows, "series_id string, day int, a double, b double, c double, target_class int")
    df = df.withColumn("date", F.date_add(F.lit("2001-01-01"), "day")).withColumn("split", F.when(F.col("day") >= 300, "test").otherwise("train"))
    kinds = [models.logistic("l2"), models.boosting("classification", 2)]
    out = {(r.model, r.strategy): r for r in balance.compare_balancing(df, ["a", "b", "c"], kinds, n_splits=2).collect()}
    assert len(out) == 8 and all(r.error is None for r in out.values())
    assert all(0.7 < r.auc <= 1 and 0.6 < r.cv_auc <= 1 for r in out.values())
    assert out[kinds[0].name, "SMOTE"].recall >= out[kinds[0].name, "none"].recall
    few = df.withColumn("target_class", (F.col("day").isin(10, 200, 301)).cast("int"))
    bad = {(r.model, r.strategy): r.error for r in balance.compare_balancing(few, ["a", "b", "c"], kinds[:1], strategies=("SMOTE", "none"), n_splits=0).collect()}
    assert bad[kinds[0].name, "SMOTE"] and bad[kinds[0].name, "none"] is None


def test_buckets_hold_a_bounded_number_of_rows(spark, monkeypatch):
    """Ten times the rows, skewed values: as many rows in the largest bucket."""
    from voltide.plans import ranking

    monkeypatch.setattr(ranking, "BUCKET_ROWS", 500)
    for n in (6_000, 60_000):
        df = spark.range(n, numPartitions=90).select(F.exp(F.randn(3) * 2).alias("v"), F.lit("g").alias("g"))
        df = spark.createDataFrame(df.toPandas())
        sizes = [r["count"] for r in ranking.with_bucket(df, "v").groupBy(ranking.BUCKET).count().collect()]
        assert max(sizes) <= 2 * 500 and len(sizes) >= n / 1000
        found = ranking.exact_quantiles(df, ["g"], "v", {"p10": 0.1, "p90": 0.9}).first()
        values = np.array([r.v for r in df.select("v").collect()])
        assert abs(found.p10 - np.quantile(values, 0.1)) < 1e-12 and abs(found.p90 - np.quantile(values, 0.9)) < 1e-9
    assert ranking.exact_quantiles(df.limit(0), ["g"], "v", {"m": 0.5}).count() == 0
    same = spark.range(3000).select(F.lit(1.0).alias("v"))
    assert ranking.with_bucket(same, "v").count() == 3000
