"""Class balancing: SMOTE, ADASYN and the comparison of strategies."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltide.functions.scalars import hash_draw, hash_uniform
from voltide.plans.resampling import numbered_rows
from voltide.operators.models import Model, fit_model
from voltide.operators.metrics import auc, classification_metrics
from voltide.operators.neighbours import neighbour_join, vectors
from voltide.operators.prep import Prep, apply_prep, class_weights, fit_prep, with_weights
from voltide.operators.splits import expanding_folds
from voltide.session import discard, materialize
from voltide.settings import CV_FOLDS, SEED


class BalancingError(ValueError):
    """The sampler cannot create rows for this class distribution."""


def class_counts(train: DataFrame, label: str) -> dict[int, int]:
    rows = train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    return {int(r[label]): r["n"] for r in rows if r[label] is not None}


def _minority(train: DataFrame, label: str) -> tuple[int, int, int]:
    counts = class_counts(train, label)
    if len(counts) < 2:
        raise BalancingError("a sampler needs two classes")
    minority = min(sorted(counts), key=counts.get)
    return minority, counts[minority], sum(counts.values()) - counts[minority]


def _others(found: DataFrame, k: int) -> DataFrame:
    """Neighbours of each row without the row itself."""
    order = Window.partitionBy("qid").orderBy("distance", "tid")
    rest = found.where(F.col("qid") != F.col("tid"))
    return rest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _interpolate(draws: DataFrame, near: DataFrame, points: DataFrame) -> DataFrame:
    """``draws(qid, rank, lam)`` -> synthetic vectors between a row and the
    chosen neighbour."""
    base = points.select(F.col("id").alias("qid"), F.col("v").alias("_from"))
    other = points.select(F.col("id").alias("tid"), F.col("v").alias("_to"))
    joined = draws.join(near.select("qid", "rank", "tid"), ["qid", "rank"]).join(base, "qid").join(other, "tid")
    return joined.select(
        F.zip_with("_from", "_to", lambda a, b: a + (b - a) * F.col("lam")).alias("v")
    )


def _stack(train: DataFrame, made: DataFrame, features: Sequence[str], label: str, minority: int) -> DataFrame:
    real = train.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("int").alias(label), F.lit(False).alias("synthetic"))
    new = made.select(
        *[F.get("v", i).alias(c) for i, c in enumerate(features)], F.lit(minority).alias(label), F.lit(True).alias("synthetic")
    )
    return real.unionByName(new)


def smote(
    train: DataFrame, features: Sequence[str], label: str = "target_class", k: int = 5, seed: int = SEED, neighbours: str = "exact"
) -> DataFrame:
    """Training rows plus synthetic minority rows up to equal classes
    (Chawla et al. 2002). Draws come from a portable hash; the neighbours, exact
    or by ``lsh``, are written once."""
    minority, few, many = _minority(train, label)
    if few <= k:
        raise BalancingError(f"SMOTE needs more than {k} minority rows")
    rows = train.where(F.col(label) == minority)
    points = materialize(vectors(rows, features), "minority-points")
    near = materialize(_others(neighbour_join(points, points, k + 1, neighbours), k).select("qid", "rank", "tid"), "neighbours")
    places = numbered_rows(rows.select("series_id", "date")).select(
        "idx", F.concat_ws("|", F.col("series_id"), F.col("date").cast("string")).alias("qid")
    )
    draws = train.sparkSession.range(many - few).select(
        (hash_draw("id", F.lit("row"), seed) % F.lit(few)).alias("idx"),
        (hash_draw("id", F.lit("neighbour"), seed) % F.lit(k) + F.lit(1)).cast("int").alias("rank"),
        hash_uniform("id", F.lit("step"), seed).alias("lam"),
    )
    return _stack(train, _interpolate(draws.join(places, "idx"), near, points), features, label, minority)


def adasyn(
    train: DataFrame, features: Sequence[str], label: str = "target_class", k: int = 5, seed: int = SEED, neighbours: str = "exact"
) -> DataFrame:
    """Like SMOTE, but a minority row gets new rows in proportion to the share
    of majority rows among its neighbours (He et al. 2008)."""
    minority, few, many = _minority(train, label)
    if few <= k:
        raise BalancingError(f"ADASYN needs more than {k} minority rows")
    rows = train.where(F.col(label) == minority)
    points = materialize(vectors(rows, features, label), "minority-points")
    every = materialize(vectors(train, features, label), "training-points")
    around = _others(neighbour_join(points, every, k + 1, neighbours), k)
    hard = materialize(around.groupBy("qid").agg(F.avg((F.col("y") != minority).cast("double")).alias("_r")), "hardness")
    total = hard.agg(F.sum("_r")).first()[0] or 0.0
    if total == 0.0 or many == few:
        raise BalancingError("ADASYN would not create any rows for this class ratio")
    quota = F.round(F.col("_r") / F.lit(total) * F.lit(float(many - few))).cast("int")
    if not hard.agg(F.sum(quota)).first()[0]:
        raise BalancingError("ADASYN would not create any rows for this class ratio")
    draws = (
        hard.withColumn("_g", quota)
        .where(F.col("_g") > 0)
        .select("qid", F.explode(F.sequence(F.lit(1), F.col("_g"))).alias("i"))
        .select(
            "qid",
            (hash_draw("qid", "i", F.lit("neighbour"), seed) % F.lit(k) + F.lit(1)).cast("int").alias("rank"),
            hash_uniform("qid", "i", F.lit("step"), seed).alias("lam"),
        )
    )
    near = materialize(_others(neighbour_join(points, points, k + 1, neighbours), k).select("qid", "rank", "tid"), "neighbours")
    return _stack(train, _interpolate(draws, near, points), features, label, minority)


STRATEGIES = ("none", "SMOTE", "ADASYN", "class_weight=balanced")


SAMPLERS = {"SMOTE": smote, "ADASYN": adasyn}
SCORES = ("accuracy", "precision", "recall", "f1", "auc")


def _fitted_predictions(
    train: DataFrame, test: DataFrame, prep: Prep, features: Sequence[str], label: str, models: Sequence[Model], strategy: str, neighbours: str
):
    """Predictions of each model under one strategy, or the error of the sampler.
    Filled and scaled rows, and what a sampler makes of them, are written once
    for all models that share the scaling."""
    out, ready = {}, {}
    for model in models:
        try:
            if strategy == "none":
                fitted, rows = fit_model(train, features, label, model, prep=prep), test
            elif strategy == "class_weight=balanced":
                weighted = with_weights(train, class_weights(train, label), label)
                fitted, rows = fit_model(weighted, features, label, model, weight="weight", prep=prep), test
            else:
                if model.scale not in ready:
                    filled = materialize(apply_prep(train, prep, model.scale), "filled")
                    ready[model.scale] = materialize(SAMPLERS[strategy](filled, features, label, neighbours=neighbours), "sampled")
                    discard(filled)
                # The sampled rows are filled and scaled: the model takes them as they are.
                fitted = fit_model(ready[model.scale], features, label, replace(model, scale=False), prep=prep)
                rows = apply_prep(test, prep, model.scale)
            out[model.name] = fitted.predict(rows)
        except BalancingError as failure:
            out[model.name] = str(failure)
    return out


def compare_balancing(
    table: DataFrame, features: Sequence[str], models: Sequence[Model], label: str = "target_class",
    strategies: Sequence[str] = STRATEGIES, n_splits: int = CV_FOLDS, threads: int = 4, neighbours: str = "exact",
) -> DataFrame:
    """Test metrics and mean AUC over expanding folds (``cv_auc``) of every model
    under every strategy; sampling sees training rows only. A strategy that fails
    in a part stays in the table with its error text."""
    unknown = set(strategies) - set(STRATEGIES)
    if unknown:
        raise ValueError(f"unknown strategies {sorted(unknown)}")
    history = materialize(table.where(F.col("split") != "test").where(F.col(label).isNotNull()).drop("row_idx", "n_rows"), "history")
    test = materialize(table.where((F.col("split") == "test") & F.col(label).isNotNull()), "test")
    folds = materialize(expanding_folds(history, n_splits), "folds") if n_splits else None
    parts = [(-1, history, test)]
    for f in range(n_splits):
        here = folds.where(F.col("fold") == f)
        parts.append((f, here.where(F.col("role") == "train"), here.where(F.col("role") == "test")))
    with ThreadPoolExecutor(threads) as pool:
        preps = list(pool.map(lambda p: fit_prep(p[1], features, label), parts))
    parts = [(*p, prep) for p, prep in zip(parts, preps)]

    def run(task):
        (fold, train, held, prep), strategy = task
        done = []
        for name, found in _fitted_predictions(train, held, prep, features, label, models, strategy, neighbours).items():
            if isinstance(found, str):
                done.append((name, strategy, fold, found, None))
            else:
                rows = found.select(F.lit(name).alias("model"), F.lit(strategy).alias("strategy"), F.lit(fold).alias("part"), "y_true", "y_class", "y_score")
                done.append((name, strategy, fold, None, materialize(rows, "balanced-predictions")))
        return done

    with ThreadPoolExecutor(threads) as pool:
        done = [one for some in pool.map(run, [(p, s) for s in strategies for p in parts]) for one in some]
    failed = {(m, s): text for m, s, _, text, _ in done if text}
    written = [df for m, s, _, _, df in done if df is not None and (m, s) not in failed]
    spark = table.sparkSession
    wanted = spark.createDataFrame([(m.name, s, failed.get((m.name, s))) for m in models for s in strategies], "model string, strategy string, error string")
    if not written:
        return wanted.select("model", "strategy", *[F.lit(None).cast("double").alias(c) for c in ("cv_auc", *SCORES)], "error")
    preds = written[0]
    for one in written[1:]:
        preds = preds.unionByName(one)
    preds = materialize(preds.coalesce(8), "all-balanced-predictions")
    keys = ["model", "strategy", "part"]
    areas = auc(preds, keys).select(*keys, "auc")
    scores = classification_metrics(preds.where(F.col("part") < 0), keys[:2]).join(areas.where(F.col("part") < 0), keys[:2])
    over_folds = areas.where(F.col("part") >= 0).groupBy(*keys[:2]).agg(F.avg("auc").alias("cv_auc"))
    # Without folds cv_auc is null.
    out = wanted.join(scores, keys[:2], "left").join(over_folds, keys[:2], "left")
    return out.select(*keys[:2], "cv_auc", *SCORES, "error")
