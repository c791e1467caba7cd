"""Forecast metrics and curves over a long prediction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltide.functions.scalars import ratio
from voltide.plans.ranking import running_totals
from voltide.plans.resampling import SumMetric

# Qualitative complexity of each model, 0 to 5.
COMPLEXITY = {
    "Naive": 0, "Rolling Mean": 0, "EWMA": 0,
    "ARIMA": 1, "GARCH(1,1)": 2,
    "KNN": 1, "Ridge": 1, "Lasso": 1, "ElasticNet": 1,
    "Naive Bayes": 1, "LogReg L1": 1, "LogReg L2": 1,
    "Decision Tree": 2, "Random Forest": 3,
    "SVR": 3, "SVM": 3,
    "XGBoost": 3, "LightGBM": 3, "CatBoost": 3,
    "MLP": 4, "LSTM": 5,
    "Regime Mixture": 5,
}
DEFAULT_COMPLEXITY = 3


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg((y - p) * (y - p)))


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


#: The metrics as functions of weighted sums, for the bootstrap.
RMSE = SumMetric(lambda y, p: [(y - p) * (y - p)], lambda n, s: F.sqrt(F.try_divide(s[0], n)))
MAE = SumMetric(lambda y, p: [F.abs(y - p)], lambda n, s: F.try_divide(s[0], n))
R2 = SumMetric(
    lambda y, p: [(y - p) * (y - p), y, y * y], lambda n, s: 1.0 - F.try_divide(s[0], s[2] - F.try_divide(s[1] * s[1], n))
)


def r2(y: Column, p: Column) -> Column:
    """1 - SSE/SST over the rows that have a prediction."""
    known = F.when(p.isNotNull(), y)
    return F.lit(1.0) - F.try_divide(F.sum((y - p) * (y - p)), F.var_pop(known) * F.count(y - p))


def regression_metrics(preds: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    y, p = F.col("y_true"), F.col("y_pred")
    return preds.groupBy(*keys).agg(
        F.count(y - p).alias("n"), rmse(y, p).alias("rmse"), mae(y, p).alias("mae"), r2(y, p).alias("r2")
    )


def benchmark_table(preds: DataFrame, seconds: DataFrame | None = None) -> DataFrame:
    """Metrics per model, best RMSE first; ``seconds(model, seconds)`` optional."""
    table = regression_metrics(preds)
    if seconds is not None:
        table = table.join(seconds, "model", "left")
    return table.orderBy("rmse", "model")


def classification_metrics(preds: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Accuracy, precision, recall and F1; an empty denominator gives 0."""
    y, c = F.col("y_true"), F.col("y_class")
    counts = preds.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if((y == 1) & (c == 1)).alias("_tp"),
        F.count_if((y == 0) & (c == 1)).alias("_fp"),
        F.count_if((y == 1) & (c == 0)).alias("_fn"),
        F.count_if(y == c).alias("_ok"),
    )
    tp, fp, fn = F.col("_tp"), F.col("_fp"), F.col("_fn")

    def share(a: Column, b: Column) -> Column:
        return F.coalesce(ratio(a, b), F.lit(0.0))

    return counts.select(
        *keys,
        "n",
        share(F.col("_ok"), F.col("n")).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def score_counts(preds: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Positives and negatives per distinct score: ties collapse before any
    ordering happens."""
    return preds.groupBy(*keys, F.col("y_score").alias("score")).agg(
        F.count_if(F.col("y_true") == 1).alias("n_pos"), F.count_if(F.col("y_true") == 0).alias("n_neg")
    )


def auc(preds: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Tie-aware rank AUC; null when a class is absent."""
    curve = running_totals(score_counts(preds, keys), keys, "score", ["n_pos", "n_neg"])
    wins = F.sum(F.col("n_pos") * (F.col("cum_n_neg") - F.col("n_neg") / F.lit(2.0)))
    pairs = F.max(F.col("all_n_pos") * F.col("all_n_neg"))
    return curve.groupBy(*keys).agg(
        F.max("all_n_pos").alias("n_pos"), F.max("all_n_neg").alias("n_neg"), ratio(wins, pairs).alias("auc")
    )


def roc_curve(preds: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """False and true positive rate at every distinct threshold, and the start
    point (0, 0) at an infinite one."""
    counts = score_counts(preds, keys)
    curve = running_totals(counts, keys, "score", ["n_pos", "n_neg"], descending=True)
    start = counts.select(*keys).distinct().select(*keys, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(_curve_points(curve, keys))


def _curve_points(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    return curve.select(
        *keys,
        F.col("score").alias("threshold"),
        ratio("cum_n_neg", "all_n_neg").alias("fpr"),
        ratio("cum_n_pos", "all_n_pos").alias("tpr"),
    )


def confusion_matrix(preds: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    cells = [
        F.count_if((F.col("y_true") == t) & (F.col("y_class") == c)).alias(n)
        for n, t, c in (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    ]
    return preds.groupBy(*keys).agg(*cells)


def cv_summary(fold_metrics: DataFrame, metrics: Sequence[str], keys: Sequence[str] = ("model",)) -> DataFrame:
    """Mean and population std over folds."""
    return fold_metrics.groupBy(*keys).agg(
        *[F.avg(m).alias(f"{m}_mean") for m in metrics], *[F.stddev_pop(m).alias(f"{m}_std") for m in metrics]
    )


def overfit_gap(preds: DataFrame) -> DataFrame:
    """R2 on training rows against test rows, in one pass."""
    y, p = F.col("y_true"), F.col("y_pred")

    def on(split: str) -> Column:
        here = F.col("split") == split
        return r2(F.when(here, y), F.when(here, p))

    out = preds.groupBy("model").agg(on("train").alias("r2_train"), on("test").alias("r2_test"))
    return out.withColumn("gap", F.col("r2_train") - F.col("r2_test"))


def residual_summary(preds: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    e = F.col("y_true") - F.col("y_pred")
    return preds.groupBy(*keys).agg(
        F.avg(e).alias("mean"),
        F.stddev_pop(e).alias("std"),
        F.min(e).alias("min"),
        F.max(e).alias("max"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        F.avg(F.abs(e)).alias("mae"),
    )


def master_table(preds: DataFrame, intervals: DataFrame) -> DataFrame:
    """All models with RMSE, its interval, MAE and R2, best first."""
    scored = preds.where(F.col("y_pred").isNotNull())
    table = regression_metrics(scored, ["category", "model"])
    return table.join(intervals.select("model", "ci_lower", "ci_upper"), "model", "left").orderBy("rmse", "model")


def with_complexity(table: DataFrame, complexity: dict[str, int] | None = None) -> DataFrame:
    """Left join with the fixed complexity list; unknown models get 3."""
    fixed = COMPLEXITY if complexity is None else complexity
    lookup = table.sparkSession.createDataFrame(list(fixed.items()), "model string, complexity int")
    return table.join(F.broadcast(lookup), "model", "left").withColumn(
        "complexity", F.coalesce("complexity", F.lit(DEFAULT_COMPLEXITY))
    )


def best_of_group(table: DataFrame, group: str = "category", metric: str = "rmse") -> DataFrame:
    """Model with the lowest metric per group (ties: first by name)."""
    order = F.struct(F.col(metric), F.col("model"))
    return table.groupBy(group).agg(F.min_by("model", order).alias("model"), F.min(metric).alias(metric))


def improvement_report(table: DataFrame, baseline: str, metric: str = "rmse") -> DataFrame:
    """Absolute and percentage gain over one model's metric."""
    base = table.where(F.col("model") == baseline).agg(F.max(metric).alias("_base"))
    return (
        table.join(F.broadcast(base))
        .withColumns(
            {
                "improvement": F.col("_base") - F.col(metric),
                "improvement_pct": ratio((F.col("_base") - F.col(metric)) * 100, "_base"),
            }
        )
        .drop("_base")
    )


def real_vs_predicted(preds: DataFrame) -> DataFrame:
    """Plot table: every row with the RMSE and R2 of its model. The metric
    side has one row per model."""
    scores = regression_metrics(preds).select("model", "rmse", "r2")
    return preds.join(F.broadcast(scores), "model").select(
        "series_id", "date", "model", "y_true", "y_pred", "rmse", "r2"
    )


def convergence(trials: DataFrame) -> DataFrame:
    """Running best per search method (a table of trials, not of data rows)."""
    so_far = Window.partitionBy("method").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    return trials.withColumns({"best_rmse": F.min("rmse").over(so_far), "n_evaluations": F.count("rmse").over(so_far)})


def search_comparison(trials: DataFrame, baseline_rmse: float) -> DataFrame:
    best = trials.groupBy("method").agg(
        F.min("rmse").alias("rmse"),
        F.min_by("params", F.struct("rmse", "i")).alias("params"),
        F.count(F.lit(1)).alias("n_evaluations"),
        F.sum("seconds").alias("seconds"),
    )
    base = F.lit(float(baseline_rmse))
    return best.withColumns(
        {
            "seconds_per_eval": ratio("seconds", "n_evaluations"),
            "improvement": base - F.col("rmse"),
            "improvement_pct": ratio((base - F.col("rmse")) * 100, base),
        }
    ).orderBy("rmse", "method")
