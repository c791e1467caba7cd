"""Formal comparison of forecasters: Diebold-Mariano, DeLong, bootstrap."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltide.functions.scalars import normal_two_sided, ratio
from voltide.plans.layout import block_window, blocked, with_row_index, without_halo
from voltide.plans.ranking import running_totals
from voltide.plans.resampling import SumMetric, replicate_aucs, weighted_sums
from voltide.settings import BOOTSTRAPS, CONFIDENCE, SEED

ROW = ("series_id", "date")


def model_names(preds: DataFrame) -> list[str]:
    """Names of the models in a long table (a list of forecasters, not data)."""
    return sorted(r["model"] for r in preds.select("model").distinct().collect())


def wide_by_model(preds: DataFrame, models: Sequence[str], value: Column, extra: Sequence[str] = ("y_true",)) -> DataFrame:
    """One row per (series, date) with a column per model; rows that lack one
    of the models are dropped. Columns are named by position."""
    rows = preds.withColumn("_v", value)
    columns = [F.max(F.when(F.col("model") == m, F.col("_v"))).alias(f"m{i}") for i, m in enumerate(models)]
    wide = rows.groupBy(*ROW).agg(*[F.max(c).alias(c) for c in extra], *columns)
    return wide.dropna(subset=[f"m{i}" for i in range(len(models))])


def loss_column(loss: str) -> Column:
    e = F.col("y_true") - F.col("y_pred")
    if loss == "mse":
        return e * e
    if loss == "mae":
        return F.abs(e)
    raise ValueError("loss must be 'mse' or 'mae'")


def _dm_statistic(mean: Column, variance: Column, n: Column) -> Column:
    variance = variance / n
    return F.when(variance > 0, mean / F.sqrt(variance)).otherwise(F.lit(0.0))


def diebold_mariano(
    preds: DataFrame, model_a: str, model_b: str, h: int = 1, loss: str = "mse", keys: Sequence[str] = ("series_id",)
) -> DataFrame:
    """Statistic and p-value of one model pair with a lag-window variance of
    ``h - 1`` lags. A variance of 0 or less gives (0, 1)."""
    keys = list(keys)
    d = wide_by_model(preds, [model_a, model_b], loss_column(loss)).select(*ROW, (F.col("m0") - F.col("m1")).alias("d"))
    if h > 1:
        w = block_window()
        d = blocked(with_row_index(d), back=h - 1)
        d = without_halo(d.withColumns({f"_l{k}": F.lag("d", k).over(w) for k in range(1, h)}))
    sums = d.groupBy(*keys).agg(
        F.count("d").alias("n"),
        F.avg("d").alias("mean_d"),
        F.var_samp("d").alias("_var"),
        *[F.covar_samp(F.when(F.col(f"_l{k}").isNotNull(), F.col("d")), F.col(f"_l{k}")).alias(f"_c{k}") for k in range(1, h)],
    )
    variance: Column = F.col("_var")
    for k in range(1, h):
        variance = variance + F.lit(2.0 * (1.0 - k / h)) * F.col(f"_c{k}")
    out = sums.select(*keys, "n", "mean_d", _dm_statistic(F.col("mean_d"), variance, F.col("n")).alias("dm_stat"))
    return out.withColumn("p_value", normal_two_sided("dm_stat"))


def _pair_rows(sums: DataFrame, keys: Sequence[str], models: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Turn one wide row of pair statistics into one row per model pair."""
    pairs = [
        F.struct(
            F.lit(models[i]).alias("model_a"),
            F.lit(models[j]).alias("model_b"),
            *[F.col(f"{f}_{i}_{j}").alias(f) for f in fields],
        )
        for i, j in combinations(range(len(models)), 2)
    ]
    return sums.select(*keys, F.explode(F.array(*pairs)).alias("_p")).select(*keys, "_p.*")


def _mirrored(pairs: DataFrame, same: Sequence[str], opposite: Sequence[str]) -> DataFrame:
    turned = pairs.select(
        *[
            F.col("model_b").alias("model_a") if c == "model_a"
            else F.col("model_a").alias("model_b") if c == "model_b"
            else (-F.col(c)).alias(c) if c in opposite
            else F.col(c)
            for c in pairs.columns
        ]
    )
    return pairs.unionByName(turned)


def diebold_mariano_matrix(
    preds: DataFrame,
    models: Sequence[str],
    loss: str = "mse",
    keys: Sequence[str] = (),
    mirrored: bool = True,
) -> DataFrame:
    """All model pairs from one aggregation over one wide row per date: no
    pair of rows is ever produced. ``diff_rmse`` changes sign with the pair."""
    wide = wide_by_model(preds, models, F.col("y_pred"))

    def loss_of(i: int) -> Column:
        e = F.col("y_true") - F.col(f"m{i}")
        return e * e if loss == "mse" else F.abs(e)

    loss_column(loss)
    index = list(combinations(range(len(models)), 2))
    sums = wide.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sqrt(F.avg(F.pow(F.col("y_true") - F.col(f"m{i}"), F.lit(2.0)))).alias(f"_r{i}") for i in range(len(models))],
        *[F.avg(loss_of(i) - loss_of(j)).alias(f"_m_{i}_{j}") for i, j in index],
        *[F.var_samp(loss_of(i) - loss_of(j)).alias(f"_s_{i}_{j}") for i, j in index],
    )
    sums = sums.select(
        *keys,
        *[_dm_statistic(F.col(f"_m_{i}_{j}"), F.col(f"_s_{i}_{j}"), F.col("n")).alias(f"dm_stat_{i}_{j}") for i, j in index],
        *[(F.col(f"_r{i}") - F.col(f"_r{j}")).alias(f"diff_rmse_{i}_{j}") for i, j in index],
    )
    pairs = _pair_rows(sums, keys, models, ["dm_stat", "diff_rmse"])
    pairs = pairs.withColumn("p_value", normal_two_sided("dm_stat"))
    return _mirrored(pairs, ["p_value"], ["dm_stat", "diff_rmse"]) if mirrored else pairs


def midranks(df: DataFrame, keys: Sequence[str], value: str, name: str = "midrank") -> DataFrame:
    """1-based rank with ties averaged."""
    keys = list(keys)
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_totals(counted, keys, value, ["_n"])
    rank = F.col("cum__n") - (F.col("_n") - F.lit(1)) / F.lit(2.0)
    return df.join(placed.select(*keys, value, rank.alias(name)), [*keys, value])


def delong_components(preds: DataFrame) -> DataFrame:
    """Structural component of every row for its model: for a positive the
    share of negatives it beats, for a negative the share of positives that
    beat it (ties count one half)."""
    counts = preds.groupBy("model", "y_score").agg(
        F.count_if(F.col("y_true") == 1).alias("_p"), F.count_if(F.col("y_true") == 0).alias("_q")
    )
    placed = running_totals(counts, ["model"], "y_score", ["_p", "_q"])
    beats = ratio(F.col("cum__q") - F.col("_q") / F.lit(2.0), "all__q")
    beaten = F.lit(1.0) - ratio(F.col("cum__p") - F.col("_p") / F.lit(2.0), "all__p")
    placed = placed.select("model", "y_score", beats.alias("_v10"), beaten.alias("_v01"))
    component = F.when(F.col("y_true") == 1, F.col("_v10")).otherwise(F.col("_v01"))
    return preds.join(placed, ["model", "y_score"]).select(*ROW, "model", "y_true", component.alias("component"))


def delong_matrix(preds: DataFrame, models: Sequence[str], mirrored: bool = True) -> DataFrame:
    """AUC difference, variance, z and p for all model pairs. Components are
    computed once per model; pairs come from one aggregation."""
    wide = wide_by_model(delong_components(preds), models, F.col("component"))
    pos, neg = F.col("y_true") == 1, F.col("y_true") == 0
    index = list(combinations(range(len(models)), 2))
    gaps = {f"_d_{i}_{j}": F.col(f"m{i}") - F.col(f"m{j}") for i, j in index}
    sums = wide.groupBy().agg(
        F.count_if(pos).alias("_p"),
        F.count_if(neg).alias("_q"),
        *[F.avg(F.when(pos, g)).alias(f"delta{n[2:]}") for n, g in gaps.items()],
        *[F.var_samp(F.when(pos, g)).alias(f"_s10{n[2:]}") for n, g in gaps.items()],
        *[F.var_samp(F.when(neg, g)).alias(f"_s01{n[2:]}") for n, g in gaps.items()],
    )
    empty = (F.col("_p") == 0) | (F.col("_q") == 0)
    columns = []
    for i, j in index:
        variance = ratio(f"_s10_{i}_{j}", "_p") + ratio(f"_s01_{i}_{j}", "_q")
        delta = F.col(f"delta_{i}_{j}")
        columns.append(F.when(empty, 0.0).otherwise(delta).alias(f"delta_auc_{i}_{j}"))
        columns.append(F.when(empty, 0.0).otherwise(variance).alias(f"variance_{i}_{j}"))
        columns.append(
            F.when(~empty & (variance > 0), delta / F.sqrt(variance)).otherwise(F.lit(0.0)).alias(f"z_{i}_{j}")
        )
    pairs = _pair_rows(sums.select(*columns), [], models, ["delta_auc", "variance", "z"])
    pairs = pairs.withColumn("p_value", normal_two_sided("z"))
    return _mirrored(pairs, ["variance", "p_value"], ["delta_auc", "z"]) if mirrored else pairs


def delong_pair(preds: DataFrame, model_a: str, model_b: str) -> DataFrame:
    two = preds.where(F.col("model").isin(model_a, model_b))
    return delong_matrix(two, [model_a, model_b], mirrored=False)


def p_value_matrix(pairs: DataFrame, models: Sequence[str], value: str = "p_value") -> DataFrame:
    """Square form of a mirrored pair table."""
    return pairs.groupBy("model_a").pivot("model_b", list(models)).agg(F.first(value))


def bonferroni(pairs: DataFrame, alpha: float = 0.05, keys: Sequence[str] = ()) -> DataFrame:
    """Threshold and number of significant pairs before and after correction."""
    p = F.col("p_value")
    known = pairs.where(p.isNotNull() & (F.col("model_a") < F.col("model_b")))
    counts = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    adjusted = known.withColumn("_n", F.count(F.lit(1)).over(counts))
    return adjusted.groupBy(*keys).agg(
        F.lit(alpha).alias("alpha_original"),
        F.count(F.lit(1)).alias("n_comparisons"),
        F.coalesce(ratio(F.lit(alpha), F.max("_n")), F.lit(alpha)).alias("alpha_bonferroni"),
        F.count_if(p < alpha).alias("n_significant_uncorrected"),
        F.count_if(p < F.lit(alpha) / F.col("_n")).alias("n_significant_bonferroni"),
    )


def bootstrap_intervals(
    preds: DataFrame,
    models: Sequence[str],
    metric: SumMetric,
    n_boot: int = BOOTSTRAPS,
    level: float = CONFIDENCE,
    seed: int = SEED,
    method: str = "draws",
    value: str = "y_pred",
) -> DataFrame:
    """Percentile interval of any metric of sums, e.g. ``metrics.RMSE``. All
    models see the same resamples."""
    names = [f"m{i}" for i in range(len(models))]
    wide = wide_by_model(preds, models, F.col(value)).withColumn("y_true", F.col("y_true").cast("double"))
    terms = {f"{n}_{k}": t for n in names for k, t in enumerate(metric.terms(F.col("y_true"), F.col(n)))}
    sums = weighted_sums(wide, terms, n_boot, seed, method)
    of_model = lambda n: [F.col(c) for c in terms if c.startswith(f"{n}_")]
    scores = sums.select("rep", *[metric.value(F.col("weight"), of_model(n)).alias(n) for n in names])
    low, high = (1 - level) / 2, (1 + level) / 2
    per_model = [
        F.struct(
            F.lit(m).alias("model"),
            F.avg(n).alias("mean"),
            F.median(n).alias("median"),
            F.percentile(n, low).alias("ci_lower"),
            F.percentile(n, high).alias("ci_upper"),
            F.count(n).alias("n_boot"),
        ).alias(n)
        for m, n in zip(models, names)
    ]
    row = scores.agg(*per_model)
    return row.select(F.explode(F.array(*names)).alias("_m")).select("_m.*", F.lit(level).alias("ci_level"))


def bootstrap_auc_difference(
    preds: DataFrame, model_a: str, model_b: str, n_boot: int = 2000, seed: int = SEED, method: str = "draws"
) -> DataFrame:
    """Paired resamples of two AUCs; z = difference / sd of resampled
    differences. Replicates with a single class are left out."""
    wide = wide_by_model(preds, [model_a, model_b], F.col("y_score"))
    areas = replicate_aucs(wide, "y_true", ["m0", "m1"], n_boot, seed, method)
    per_rep = areas.groupBy("rep").agg(
        (F.max(F.when(F.col("side") == 0, F.col("auc"))) - F.max(F.when(F.col("side") == 1, F.col("auc")))).alias("d")
    )
    out = per_rep.agg(
        F.max(F.when(F.col("rep") == 0, F.col("d"))).alias("delta_auc"),
        F.stddev_pop(F.when(F.col("rep") > 0, F.col("d"))).alias("sd"),
        F.count(F.when(F.col("rep") > 0, F.col("d"))).alias("n_boot"),
    )
    z = F.when(F.col("sd") > 0, F.col("delta_auc") / F.col("sd")).otherwise(F.lit(0.0))
    return out.withColumn("z", z).withColumn("p_value", normal_two_sided("z"))
