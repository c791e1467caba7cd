"""Global and local explanations of fitted forecasters."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltide.functions.scalars import hash_draw
from voltide.plans.resampling import numbered_rows
from voltide.operators.models import Fitted
from voltide.plans.ranking import column_quantiles, running_totals
from voltide.session import scratch_path
from voltide.settings import SEED

IMPORTANCE_KINDS = ("gain", "weight", "cover", "total_gain", "total_cover")


def importance(fitted: Fitted, spark, kind: str = "gain", top_k: int = 15) -> DataFrame:
    """Split statistics of a tree ensemble by feature name, from the saved
    node table of the model."""
    if kind not in IMPORTANCE_KINDS:
        raise ValueError(f"kind must be one of {IMPORTANCE_KINDS}")
    path = scratch_path(spark, "trees")
    fitted.pipeline.stages[-1].write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    node = "nodeData" if "nodeData" in nodes.columns else None
    fields = nodes.select(f"{node}.*") if node else nodes
    splits = fields.where(F.col("split.featureIndex") >= 0)
    gain, cover = F.col("gain") * F.col("rawCount"), F.col("rawCount").cast("double")
    table = splits.groupBy(F.col("split.featureIndex").alias("index")).agg(
        F.count(F.lit(1)).cast("double").alias("weight"), F.sum(gain).alias("total_gain"), F.sum(cover).alias("total_cover")
    )
    table = table.withColumns({"gain": F.col("total_gain") / F.col("weight"), "cover": F.col("total_cover") / F.col("weight")})
    names = F.array(*[F.lit(f) for f in fitted.prep.features])
    return (
        table.select(F.get(names, F.col("index")).alias("feature"), F.col(kind).alias("importance"))
        .orderBy(F.col("importance").desc(), "feature")
        .limit(top_k)
    )


def permutation_importance(fitted: Fitted, test: DataFrame, repeats: int = 10, seed: int = SEED, top_k: int | None = 15) -> DataFrame:
    """RMSE increase when one feature takes the values of other rows. All
    (feature, repeat) copies are scored in one pass; each repeat has its own
    permutation, a ranking of the rows by hash."""
    features, label = list(fitted.prep.features), fitted.label
    rows = numbered_rows(test.where(F.col(label).isNotNull()).select("series_id", "date", label, *features))
    x = F.array(*[F.col(f).cast("double") for f in features])
    rows = rows.select("idx", F.col(label).cast("double").alias(label), x.alias("x"))
    keyed = rows.select("idx", F.explode(F.sequence(F.lit(1), F.lit(repeats))).alias("rep"))
    keyed = keyed.withColumn("h", hash_draw("rep", "idx", seed) * F.lit(2.0**31) + F.col("idx"))
    placed = running_totals(keyed.withColumn("one", F.lit(1)), ["rep"], "h", ["one"])
    source = placed.select("rep", "idx", (F.col("cum_one") - F.lit(1)).alias("from_idx"))
    donors = rows.select(F.col("idx").alias("from_idx"), F.col("x").alias("donor"))
    mixed = rows.join(source, "idx").join(donors, "from_idx")
    copies = mixed.select("rep", label, "x", "donor", F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))).alias("j"))
    whole = rows.select(F.lit(0).alias("rep"), label, "x", F.col("x").alias("donor"), F.lit(-1).alias("j"))
    stacked = copies.unionByName(whole).select(
        "rep", "j", label, *[F.when(F.col("j") == i, F.get("donor", i)).otherwise(F.get("x", i)).alias(f) for i, f in enumerate(features)]
    )
    scored = fitted.pipeline.transform(stacked)
    errors = scored.groupBy("j", "rep").agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col("prediction"), F.lit(2.0)))).alias("rmse"))
    base = errors.where(F.col("j") == -1).select(F.col("rmse").alias("_base"))
    names = F.array(*[F.lit(f) for f in features])
    gains = errors.where(F.col("j") >= 0).join(F.broadcast(base)).withColumn("gain", F.col("rmse") - F.col("_base"))
    out = gains.groupBy(F.get(names, F.col("j")).alias("feature")).agg(
        F.avg("gain").alias("importance_mean"), F.stddev_pop("gain").alias("importance_std")
    ).orderBy(F.col("importance_mean").desc(), "feature")
    return out.limit(top_k) if top_k else out


def representative_cases(preds: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Best, worst and median row by absolute error (ties: earliest row)."""
    keys = list(keys)
    e = preds.where(F.col("y_pred").isNotNull()).withColumn("abs_error", F.abs(F.col("y_true") - F.col("y_pred")))
    row = F.struct("abs_error", "series_id", "date", "y_true", "y_pred")
    counted = e.groupBy(*keys, "abs_error").agg(F.count(F.lit(1)).alias("_n"), F.min(row).alias("_row"))
    placed = running_totals(counted, keys, "abs_error", ["_n"])
    middle = F.floor(F.col("all__n") / F.lit(2.0))
    is_middle = (F.col("cum__n") > middle) & (F.col("cum__n") - F.col("_n") <= middle)
    picked = placed.groupBy(*keys).agg(
        F.min_by("_row", "abs_error").alias("best"),
        F.max_by("_row", "abs_error").alias("worst"),
        F.max(F.when(is_middle, F.col("_row"))).alias("median"),
    )
    long = picked.select(
        *keys, F.explode(F.array(*[F.struct(F.lit(c).alias("case"), F.col(c).alias("r")) for c in ("best", "worst", "median")])).alias("_c")
    )
    return long.select(*keys, "_c.case", "_c.r.series_id", "_c.r.date", "_c.r.y_true", "_c.r.y_pred", "_c.r.abs_error")


CHUNK = 500


def explain_locally(
    fitted: Fitted, train: DataFrame, instances: DataFrame, samples: int = 5000, top: int = 10, seed: int = SEED
) -> DataFrame:
    """Local linear explanation (Ribeiro et al. 2016). Features are cut at the
    training quartiles; perturbed rows are drawn from those bins in parallel
    chunks and scored in one pass; each instance then needs one weighted
    regression over its own fixed number of samples.

    ``instances`` must be a short list of rows (``case`` and the features).
    """
    import numpy as np
    import pandas as pd

    features = list(fitted.prep.features)
    d = len(features)
    filled = {f: F.coalesce(F.col(f).cast("double"), F.lit(fitted.prep.median[f])) for f in features}
    ready = train.select(*[c.alias(f) for f, c in filled.items()])
    cuts = {r["column"]: (r["q1"], r["q2"], r["q3"]) for r in column_quantiles(ready, features, {"q1": 0.25, "q2": 0.5, "q3": 0.75}).collect()}

    def bin_of(f: str):
        q1, q2, q3 = cuts[f]
        return F.when(F.col(f) <= q1, 0).when(F.col(f) <= q2, 1).when(F.col(f) <= q3, 2).otherwise(3)

    # Mean, spread, limits and share of each bin: 4 rows per feature.
    binned = ready.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), bin_of(f).alias("b"), F.col(f).alias("v")) for i, f in enumerate(features)])))
    table = {
        (r["i"], r["b"]): r
        for r in binned.groupBy("i", "b").agg(
            F.count("v").alias("n"), F.avg("v").alias("m"), F.stddev_pop("v").alias("s"), F.min("v").alias("lo"), F.max("v").alias("hi")
        ).collect()
    }
    stats = np.zeros((d, 4, 5))
    for (i, b), r in table.items():
        stats[i, b] = (r["n"], r["m"], r["s"] or 0.0, r["lo"], r["hi"])
    edges = np.array([cuts[f] for f in features])

    rows = instances.select("case", F.array(*[c for c in filled.values()]).alias("x"))
    chunks = rows.crossJoin(instances.sparkSession.range(math.ceil(samples / CHUNK)).withColumnRenamed("id", "chunk"))

    def perturb(batches):
        for batch in batches:
            for r in batch.itertuples(index=False):
                rng = np.random.RandomState((seed * 1_000_003 + int(r.chunk)) % (2**32))
                x = np.asarray(r.x, dtype=float)
                home = (x[:, None] > edges).sum(axis=1)
                size = min(CHUNK, samples - int(r.chunk) * CHUNK)
                z, values = np.zeros((size, d), dtype=int), np.zeros((size, d))
                for i in range(d):
                    share = stats[i, :, 0] / stats[i, :, 0].sum()
                    b = rng.choice(4, size=size, p=share)
                    draw = rng.normal(stats[i, b, 1], np.maximum(stats[i, b, 2], 1e-12))
                    values[:, i] = np.clip(draw, stats[i, b, 3], stats[i, b, 4])
                    z[:, i] = b == home[i]
                if r.chunk == 0:
                    z[0], values[0] = 1, x
                out = {"case": [r.case] * size, "z": list(z)}
                out.update({f"_p{i}": values[:, i] for i in range(d)})
                yield pd.DataFrame(out)

    schema = "case string, z array<int>, " + ", ".join(f"_p{i} double" for i in range(d))
    drawn = chunks.mapInPandas(perturb, schema)
    drawn = drawn.select("case", "z", *[F.col(f"_p{i}").alias(f) for i, f in enumerate(features)])
    scored = fitted.pipeline.transform(drawn).select("case", "z", "prediction").join(F.broadcast(rows), "case")

    def regress(group: pd.DataFrame) -> pd.DataFrame:
        z, y = np.stack(group["z"].to_numpy()).astype(float), group["prediction"].to_numpy()
        width = 0.75 * math.sqrt(d)
        weight = np.sqrt(np.exp(-(((1.0 - z) ** 2).sum(axis=1)) / width**2))

        def solve(columns, alpha):
            zz = z[:, columns]
            zc = zz - np.average(zz, axis=0, weights=weight)
            yc = y - np.average(y, weights=weight)
            gram = (zc * weight[:, None]).T @ zc + alpha * np.eye(len(columns))
            return np.linalg.solve(gram, (zc * weight[:, None]).T @ yc)

        chosen = np.argsort(-np.abs(solve(np.arange(d), 0.01)), kind="stable")[:top]
        coefficients = solve(chosen, 1.0)
        x = np.asarray(group["x"].iloc[0], dtype=float)
        names = []
        for i in chosen:
            e, b = edges[i], int((x[i] > edges[i]).sum())
            left = "" if b == 0 else f"{e[b - 1]:.2f} < "
            right = f" > {e[2]:.2f}" if b == 3 else f" <= {e[b]:.2f}"
            names.append(f"{features[i]}{right}" if b in (0, 3) else f"{left}{features[i]}{right}")
        return pd.DataFrame({"case": group["case"].iloc[0], "feature_condition": names, "weight": coefficients})

    explained = scored.groupBy("case").applyInPandas(regress, "case string, feature_condition string, weight double")
    order = Window.partitionBy("case").orderBy(F.abs("weight").desc(), "feature_condition")
    return explained.withColumn("rank", F.row_number().over(order))
