"""Regime mixture: a router weighs one specialist per volatility regime."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.operators.comparison import bootstrap_intervals, diebold_mariano_matrix
from voltide.operators.metrics import RMSE, best_of_group, regression_metrics
from voltide.operators.models import Fitted, Model, boosting, fit_model, rbf_svr, ridge
from voltide.operators.prep import fit_pipeline, fit_prep
from voltide.operators.targets import add_regime_target
from voltide.settings import SEED

MIN_ROWS = 50


def mix(weights: Sequence[Column], forecasts: Sequence[Column], how: str = "soft") -> Column:
    """``soft``: weighted sum; ``argmax``: forecast of the heaviest regime
    (the first one on a tie); ``uniform``: plain mean."""
    if how == "uniform":
        weights, how = [F.lit(1.0 / len(forecasts))] * len(forecasts), "soft"
    if how == "soft":
        total: Column = weights[0] * forecasts[0]
        for w, f in zip(weights[1:], forecasts[1:]):
            total = total + w * f
        return total
    if how != "argmax":
        raise ValueError("how must be 'soft', 'argmax' or 'uniform'")
    top = F.greatest(*weights) if len(weights) > 1 else weights[0]
    choice = F.when(weights[0] == top, forecasts[0])
    for w, f in zip(weights[1:], forecasts[1:]):
        choice = choice.when(w == top, f)
    return choice


def default_specialists(trees: int = 200) -> list[Model]:
    return [ridge(1.0), boosting("regression", trees, 4), rbf_svr(C=2.0)]


@dataclass
class RegimeMixture:
    """Fitted router, specialists and fallback."""

    regimes: list[int]
    routers: dict[int, object]
    specialists: dict[int, Fitted]
    fallback: Fitted
    fallback_used: dict[int, bool] = field(default_factory=dict)

    def _probabilities(self, df: DataFrame) -> DataFrame:
        """``p_<regime>`` from one-vs-rest routers, normalised to sum 1."""
        keep = df.columns
        for r, router in self.routers.items():
            df = router.transform(df).select(*keep, *[c for c in df.columns if c not in keep], F.get(vector_to_array("probability"), 1).alias(f"p_{r}"))
        if not self.routers:
            return df.withColumn(f"p_{self.regimes[0]}", F.lit(1.0))
        total: Column = F.lit(0.0)
        for r in self.regimes:
            total = total + F.col(f"p_{r}")
        even = F.lit(1.0 / len(self.regimes))
        return df.withColumns({f"p_{r}": F.coalesce(F.try_divide(F.col(f"p_{r}"), total), even) for r in self.regimes})

    def regime_probabilities(self, df: DataFrame) -> DataFrame:
        return self._probabilities(df)

    def components(self, df: DataFrame) -> DataFrame:
        """Router probabilities ``p_r`` and specialist forecasts ``f_r``."""
        out = self._probabilities(df)
        for r in self.regimes:
            before = out.columns
            fitted = self.specialists.get(r, self.fallback)
            out = fitted.pipeline.transform(out).select(*before, F.col("prediction").alias(f"f_{r}"))
        return out

    def predict(self, df: DataFrame, how: str = "soft", name: str = "Regime Mixture", label: str = "target_vol_7") -> DataFrame:
        return mixture_predictions(self.components(df), self.regimes, how, name, label)


def mixture_predictions(components: DataFrame, regimes: Sequence[int], how: str, name: str, label: str) -> DataFrame:
    value = mix([F.col(f"p_{r}") for r in regimes], [F.col(f"f_{r}") for r in regimes], how)
    return components.select(
        "series_id", "date", F.lit(name).alias("model"), F.col(label).alias("y_true"), value.alias("y_pred")
    )


def fit_regime_mixture(
    table: DataFrame,
    features: Sequence[str],
    label: str = "target_vol_7",
    regime_column: str = "vol_21",
    n_regimes: int = 3,
    fit_splits: Sequence[str] = ("train", "val"),
    specialists: Sequence[Model] | None = None,
    router_trees: int = 200,
    min_rows: int = MIN_ROWS,
    keys: Sequence[str] = ("series_id",),
) -> RegimeMixture:
    """Label rows by same-day volatility, fit the router without that column,
    one specialist per regime, and a global Ridge for regimes that have fewer
    than ``min_rows`` rows."""
    features = [f for f in features if f != regime_column]
    models = list(specialists or default_specialists(router_trees))
    labelled = add_regime_target(table, regime_column, n_regimes, fit_splits, keys)
    train = labelled.where(F.col("split").isin(list(fit_splits)) & F.col(label).isNotNull())
    known = train.where(F.col("target_regime") >= 0)
    sizes = {r["target_regime"]: r["n"] for r in known.groupBy("target_regime").agg(F.count(F.lit(1)).alias("n")).collect()}
    regimes = sorted(sizes)
    prep = fit_prep(known, features, label)
    routers = {}
    if len(regimes) > 1:
        for r in regimes:
            flagged = known.withColumn("_is", (F.col("target_regime") == r).cast("double"))
            stage = GBTClassifier(labelCol="_is", maxIter=router_trees, maxDepth=4, stepSize=0.05, seed=SEED)
            routers[r] = fit_pipeline(flagged, prep, [stage], scale=False)
    fitted = {
        r: fit_model(known.where(F.col("target_regime") == r), features, label, models[r])
        for r in regimes
        if sizes[r] >= min_rows
    }
    fallback = fit_model(train, features, label, ridge(1.0))
    return RegimeMixture(regimes, routers, fitted, fallback, {r: r not in fitted for r in range(n_regimes)})


def fallback_plan(labelled: DataFrame, min_rows: int = MIN_ROWS, keys: Sequence[str] = ()) -> DataFrame:
    """Rows per regime and whether its specialist is replaced."""
    known = labelled.where(F.col("target_regime") >= 0)
    counts = known.groupBy(*keys, "target_regime").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("uses_fallback", (F.col("n_rows") < min_rows).cast("int"))


def ablations(mixture: RegimeMixture, table: DataFrame, label: str = "target_vol_7") -> DataFrame:
    """Soft, argmax and uniform mixing of one fitted mixture; one scoring pass."""
    parts = mixture.components(table)
    out = None
    for how in ("soft", "argmax", "uniform"):
        one = mixture_predictions(parts, mixture.regimes, how, f"Regime Mixture ({how})", label)
        out = one if out is None else out.unionByName(one)
    return out


def compare_with_best(preds: DataFrame, candidate: str, n_boot: int = 1000) -> DataFrame:
    """The candidate against the best model of every other category: RMSE with
    its bootstrap interval, and Diebold-Mariano against the candidate."""
    scored = regression_metrics(preds, ["category", "model"])
    rivals = best_of_group(scored.where(F.col("model") != candidate))
    names = sorted({candidate, *[r["model"] for r in rivals.collect()]})
    chosen = preds.where(F.col("model").isin(names))
    intervals = bootstrap_intervals(chosen, names, RMSE, n_boot=n_boot).select("model", "ci_lower", "ci_upper")
    pairs = diebold_mariano_matrix(chosen, names).where(F.col("model_a") == candidate)
    pairs = pairs.select(F.col("model_b").alias("model"), "dm_stat", "p_value")
    table = scored.where(F.col("model").isin(names)).select("category", "model", "rmse")
    return table.join(intervals, "model").join(pairs, "model", "left")
