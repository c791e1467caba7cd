"""Headline queries at ``$BENCH_SF_DIR``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from voltide.operators import baselines, candles, comparison, features, metrics, quality, splits, targets  # noqa: E402
from voltide.session import local_session, materialize  # noqa: E402
from voltide.sources.ticks import supplier_bars  # noqa: E402


def sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name, fn):
        start = time.time()
        out = fn()
        times[name] = round(time.time() - start, 3)
        return out

    bars = timed("bars_write", lambda: materialize(supplier_bars(spark, sf_dir), "bench-bars"))
    timed("qa_report", lambda: sink(quality.qa_report(bars)))
    timed("candle_patterns", lambda: sink(quality.pattern_frequency(candles.patterns(bars))))
    timed("volatility", lambda: sink(features.build_features(bars, columns=["vol_7", "vol_28"])))
    table = timed("features_and_targets_write", lambda: materialize(targets.features_and_targets(bars), "bench-features"))
    known = table.dropna(subset=[*features.FEATURES, "target_vol_7"])
    timed("temporal_split", lambda: sink(splits.temporal_split(known).groupBy("split").agg(F.count(F.lit(1)))))
    preds = timed(
        "walk_forward_write",
        lambda: materialize(baselines.walk_forward_predictions(table.select("series_id", "date", "vol_7"), "vol_7", 7), "bench-preds"),
    )
    timed("metrics", lambda: sink(metrics.regression_metrics(preds)))
    timed("dm_matrix", lambda: sink(comparison.diebold_mariano_matrix(preds, baselines.MODELS)))
    timed("describe", lambda: sink(quality.describe(bars, ["open", "close", "volume"])))
    print(
        json.dumps(
            {"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/"))}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
