"""Hyper-parameter search. Candidates are a few numbers on the driver; every
evaluation is a set of Spark fits over expanding folds."""

from __future__ import annotations

import itertools
import json
import math
import random
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.operators.metrics import regression_metrics
from voltide.operators.models import Model, boosting, fit_model
from voltide.operators.prep import Prep, fit_prep
from voltide.settings import CV_FOLDS, SEED


@dataclass(frozen=True)
class Range:
    """One searched parameter."""

    low: float
    high: float
    whole: bool = False
    log: bool = False

    def inner(self, value: float) -> float:
        return math.log10(value) if self.log else value

    def outer(self, x: float) -> float | int:
        low, high = self.inner(self.low), self.inner(self.high)
        x = min(max(x, low), high)
        value = 10**x if self.log else x
        return int(value) if self.whole else value

    def draw(self, rng: random.Random) -> float:
        return rng.uniform(self.inner(self.low), self.inner(self.high))


Space = dict[str, Range]
Params = dict[str, float]

# The searched parameters of boosted trees and their grid.
BOOSTING_SPACE: Space = {
    "trees": Range(50, 500, whole=True),
    "depth": Range(2, 10, whole=True),
    "rate": Range(0.005, 0.3, log=True),
    "subsample": Range(0.5, 1.0),
    "columns": Range(0.5, 1.0),
}
BOOSTING_GRID = {"trees": [100, 200, 400], "depth": [3, 5, 7], "rate": [0.01, 0.05, 0.1]}


def boosting_model(**params) -> Model:
    return boosting("regression", **params)


def trials_frame(spark: SparkSession, trials: Sequence[tuple]) -> DataFrame:
    return spark.createDataFrame(list(trials), "method string, i int, params string, rmse double, seconds double")


@dataclass
class CrossValidator:
    """Mean fold RMSE of a candidate; preprocessing is refitted per fold (once
    for all candidates, as it does not depend on them).

    ``folds`` must be a written table with ``fold`` and ``role``. With
    ``staged`` naming the number of boosting rounds, candidates that differ in
    nothing else share one fit of the largest number: the errors after each
    round come from one pass over the test rows.
    """

    folds: DataFrame
    features: Sequence[str]
    label: str
    make: Callable[..., Model]
    n_splits: int = CV_FOLDS
    threads: int = 8
    staged: str | None = None
    trials: list[tuple] = field(default_factory=list)
    _prep: dict[int, Prep] = field(default_factory=dict)

    def _part(self, fold: int, role: str) -> DataFrame:
        return self.folds.where((F.col("fold") == fold) & (F.col("role") == role) & F.col(self.label).isNotNull())

    def fit_preps(self) -> None:
        missing = [f for f in range(self.n_splits) if f not in self._prep]
        with ThreadPoolExecutor(self.threads) as pool:
            for f, p in zip(missing, pool.map(lambda f: fit_prep(self._part(f, "train"), self.features, self.label), missing)):
                self._prep[f] = p

    def fold_rmse(self, params: Params, fold: int) -> float:
        fitted = fit_model(self._part(fold, "train"), self.features, self.label, self.make(**params), prep=self._prep[fold])
        return regression_metrics(fitted.predict(self._part(fold, "test"))).first()["rmse"]

    def staged_rmse(self, params: Params, rounds: Sequence[int], fold: int) -> list[float]:
        """RMSE of the first ``rounds`` trees of one boosted fit."""
        rows = self._part(fold, "train")
        model = self.make(**{**params, self.staged: max(rounds)})
        fitted = fit_model(rows, self.features, self.label, model, prep=self._prep[fold]).pipeline
        test = self._part(fold, "test")
        for stage in fitted.stages[:-1]:
            test = stage.transform(test)
        losses = fitted.stages[-1].evaluateEachIteration(test, "squared")
        return [math.sqrt(losses[n - 1]) for n in rounds]

    def _groups(self, batch: Sequence[Params]) -> list[list[int]]:
        """Places of candidates that one fit serves."""
        if self.staged is None:
            return [[i] for i in range(len(batch))]
        groups: dict[str, list[int]] = {}
        for i, p in enumerate(batch):
            rest = json.dumps({k: v for k, v in p.items() if k != self.staged}, sort_keys=True)
            groups.setdefault(rest, []).append(i)
        return list(groups.values())

    def score(self, method: str, batch: Sequence[Params]) -> list[float]:
        """Evaluate a batch: all fits, one for each group of candidates and
        fold, share one thread pool."""
        self.fit_preps()
        jobs = [(g, f) for g in self._groups(batch) for f in range(self.n_splits)]

        def run(job):
            start, (group, fold) = time.time(), job
            if self.staged is None:
                values = [self.fold_rmse(batch[group[0]], fold)]
            else:
                values = self.staged_rmse(batch[group[0]], [int(batch[i][self.staged]) for i in group], fold)
            return values, (time.time() - start) / len(group)

        found: list[list[tuple[float, float]]] = [[] for _ in batch]
        with ThreadPoolExecutor(self.threads) as pool:
            for (group, _), (values, seconds) in zip(jobs, pool.map(run, jobs)):
                for i, value in zip(group, values):
                    found[i].append((value, seconds))
        scores = []
        for mine, params in zip(found, batch):
            scores.append(sum(r for r, _ in mine) / self.n_splits)
            number = sum(1 for t in self.trials if t[0] == method)
            self.trials.append((method, number, json.dumps(params, sort_keys=True), scores[-1], sum(s for _, s in mine)))
        return scores

    def trial_table(self) -> DataFrame:
        """One row per evaluation: ``method, i, params, rmse, seconds``."""
        return trials_frame(self.folds.sparkSession, self.trials)

    def best(self, method: str) -> Params:
        return json.loads(min((t for t in self.trials if t[0] == method), key=lambda t: (t[3], t[1]))[2])


def grid_search(cv: CrossValidator, grid: dict[str, Sequence] = BOOSTING_GRID) -> Params:
    names = list(grid)
    cv.score("Grid Search", [dict(zip(names, values)) for values in itertools.product(*grid.values())])
    return cv.best("Grid Search")


def random_search(cv: CrossValidator, space: Space = BOOSTING_SPACE, n_iter: int = 50, seed: int = SEED) -> Params:
    rng = random.Random(seed)
    cv.score("Random Search", [{n: r.outer(r.draw(rng)) for n, r in space.items()} for _ in range(n_iter)])
    return cv.best("Random Search")


def bayesian_search(
    cv: CrossValidator, space: Space = BOOSTING_SPACE, n_trials: int = 100, startup: int = 10, batch: int = 4,
    candidates: int = 24, good_share: float = 0.2, seed: int = SEED,
) -> Params:
    """Per parameter, propose where good trials are dense and bad ones are not
    (tree-structured Parzen estimator)."""
    rng, method = random.Random(seed), "Bayesian"
    seen: list[tuple[float, dict[str, float]]] = []

    def density(x: float, points: Sequence[float], width: float) -> float:
        return sum(math.exp(-0.5 * ((x - p) / width) ** 2) for p in points) / (len(points) * width) + 1e-12

    def propose() -> dict[str, float]:
        if len(seen) < startup:
            return {n: r.draw(rng) for n, r in space.items()}
        ranked = sorted(seen, key=lambda s: s[0])
        cut = max(2, math.ceil(good_share * len(ranked)))
        good, bad = [s[1] for s in ranked[:cut]], [s[1] for s in ranked[cut:]] or [s[1] for s in ranked]
        point = {}
        for n, r in space.items():
            width = (r.inner(r.high) - r.inner(r.low)) / max(3.0, math.sqrt(len(seen)))
            tries = [rng.gauss(rng.choice(good)[n], width) for _ in range(candidates)]
            tries = [min(max(x, r.inner(r.low)), r.inner(r.high)) for x in tries]
            point[n] = max(tries, key=lambda x: density(x, [g[n] for g in good], width) / density(x, [b[n] for b in bad], width))
        return point

    while len(seen) < n_trials:
        points = [propose() for _ in range(min(batch, n_trials - len(seen)))]
        scores = cv.score(method, [{n: space[n].outer(x) for n, x in p.items()} for p in points])
        seen += list(zip(scores, points))
    return cv.best(method)


def genetic_search(
    cv: CrossValidator, space: Space = BOOSTING_SPACE, population: int = 30, generations: int = 15, tournament: int = 3,
    crossover: float = 0.7, mutation: float = 0.3, gene_mutation: float = 0.3, blend: float = 0.3, seed: int = SEED,
) -> Params:
    """Tournament selection, blend crossover and bounded mutation; the children
    of one generation are evaluated as one batch."""
    rng, method = random.Random(seed), "Genetic"

    def bound(g: dict[str, float]) -> dict[str, float]:
        return {n: min(max(x, space[n].inner(space[n].low)), space[n].inner(space[n].high)) for n, x in g.items()}

    def evaluate(genes):
        return list(zip(cv.score(method, [{n: space[n].outer(x) for n, x in g.items()} for g in genes]), genes))

    pool = evaluate([{n: r.draw(rng) for n, r in space.items()} for _ in range(population)])
    for _ in range(generations):
        parents = [dict(g) for _, g in pool]
        children = []
        for a, b in zip(parents[::2], parents[1::2]):
            if rng.random() < crossover:
                for n in space:
                    w = (1.0 + 2.0 * blend) * rng.random() - blend
                    a[n], b[n] = (1 - w) * a[n] + w * b[n], w * a[n] + (1 - w) * b[n]
            children += [a, b]
        for child in children:
            if rng.random() < mutation:
                for n, r in space.items():
                    if rng.random() < gene_mutation:
                        child[n] += rng.gauss(0.0, 0.1 * (r.inner(r.high) - r.inner(r.low)))
        pool += evaluate([bound(c) for c in children])
        pool = [min(rng.sample(pool, min(tournament, len(pool))), key=lambda s: s[0]) for _ in range(population)]
    return cv.best(method)
