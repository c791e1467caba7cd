"""Search over linear models from sums of products.

One pass over the folds gives a matrix of sums for each (fold, role). Every
candidate is then fitted on the train matrix and scored on the test matrix:
hundreds of candidates cost no further Spark job.
"""

from __future__ import annotations

import copy
import json
import time
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.operators.prep import Prep, fit_prep
from voltide.operators.search import Params, Range, Space, trials_frame
from voltide.settings import CV_FOLDS

#: Bounds of the two penalties of an elastic net; 27 grid points.
LINEAR_SPACE: Space = {"alpha": Range(1e-5, 1e-1, log=True), "l1_ratio": Range(0.0, 1.0)}
LINEAR_GRID = {
    "alpha": [1e-5, 3e-5, 1e-4, 3e-4, 1e-3, 3e-3, 1e-2, 3e-2, 1e-1],
    "l1_ratio": [0.0, 0.5, 1.0],
}
ROLES = ("train", "test")


def fold_grams(folds: DataFrame, features: Sequence[str], label: str, preps: Sequence[Prep]) -> dict[tuple[int, str], np.ndarray]:
    """Matrix of sums of products of ``(1, features, label)`` per fold and role,
    features filled and scaled by the training rows of their fold. A task sends
    one matrix per fold and role; rows without a label are left out."""
    features = list(features)
    fill = np.array([[p.median[c] for c in features] for p in preps])
    mean = np.array([[p.mean[c] for c in features] for p in preps])
    spread = np.array([[p.std[c] if p.std[c] > 0 else 1.0 for c in features] for p in preps])
    width = len(features) + 2

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, str], np.ndarray] = {}
        for batch in batches:
            fold = batch.column(0).to_numpy(zero_copy_only=False)
            train = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            y = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[3:]])
            for f in np.unique(fold):
                for role, chosen in zip(ROLES, (train, ~train)):
                    here = (fold == f) & chosen
                    if not here.any():
                        continue
                    z = (np.where(np.isnan(x[here]), fill[f], x[here]) - mean[f]) / spread[f]
                    rows = np.column_stack([np.ones(len(z)), z, y[here]])
                    key = (int(f), role)
                    total[key] = total.get(key, 0.0) + rows.T @ rows
        cell = np.arange(width * width, dtype=np.int32)
        for (f, role), matrix in total.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(cell), f, dtype=np.int32)), pa.array([role] * len(cell)), pa.array(cell),
                    pa.array(matrix.ravel()),
                ],
                names=["fold", "role", "cell", "v"],
            )

    known = folds.where(F.col(label).isNotNull()).select(
        F.col("fold").cast("int"), F.col("role") == "train", F.col(label).cast("double"), *[F.col(c).cast("double") for c in features]
    )
    cells = known.mapInArrow(sums, "fold int, role string, cell int, v double").groupBy("fold", "role", "cell").agg(F.sum("v").alias("v"))
    out = {(f, role): np.zeros(width * width) for f in range(len(preps)) for role in ROLES}
    # (features + 2) squared numbers for each fold and role, whatever the rows.
    for row in cells.collect():
        out[row["fold"], row["role"]][row["cell"]] = row["v"]
    return {k: m.reshape(width, width) for k, m in out.items()}


def elastic_net_paths(grams: Sequence[np.ndarray], alpha: np.ndarray, l1_ratio: np.ndarray, sweeps: int = 3000, tol: float = 1e-7) -> np.ndarray:
    """Coefficients ``[gram, candidate, 1 + features]`` that minimise
    ``sse / 2n + alpha * l1_ratio * |b| + alpha * (1 - l1_ratio) * b.b / 2``,
    by coordinate descent over all candidates and matrices at once, started
    at the ridge solution with both penalties as squares."""
    n = np.array([g[0, 0] for g in grams])
    centre = np.array([g[0, 1:-1] / g[0, 0] for g in grams])
    level = np.array([g[0, -1] / g[0, 0] for g in grams])
    xx = np.array([g[1:-1, 1:-1] / g[0, 0] for g in grams]) - centre[:, :, None] * centre[:, None, :]
    xy = np.array([g[1:-1, -1] / g[0, 0] for g in grams]) - centre * level[:, None]
    own = np.diagonal(xx, axis1=1, axis2=2)
    lasso, ridge = alpha * l1_ratio, alpha * (1.0 - l1_ratio)
    stiff = xx[:, None] + np.maximum(alpha, 1e-12)[None, :, None, None] * np.eye(xx.shape[1])
    b = np.linalg.solve(stiff, np.broadcast_to(xy[:, None, :, None], (*stiff.shape[:2], xx.shape[1], 1)))[..., 0]
    for _ in range(sweeps):
        moved = 0.0
        for j in range(b.shape[2]):
            pull = xy[:, None, j] - (b @ xx[:, :, j, None])[:, :, 0] + b[:, :, j] * own[:, None, j]
            floor = own[:, None, j] + ridge[None, :]
            new = np.sign(pull) * np.maximum(np.abs(pull) - lasso[None, :], 0.0) / np.where(floor > 0, floor, 1.0)
            moved = max(moved, float(np.abs(new - b[:, :, j]).max(initial=0.0)))
            b[:, :, j] = new
        if moved < tol:
            break
    return np.concatenate([(level[:, None] - (b @ centre[:, :, None])[:, :, 0])[:, :, None], b], axis=2)


def rmse_from_gram(gram: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Test RMSE of each row of coefficients ``b`` from sums alone."""
    full = np.concatenate([b, -np.ones((len(b), 1))], axis=1)
    return np.sqrt(np.maximum(np.einsum("ci,ij,cj->c", full, gram, full), 0.0) / gram[0, 0])


class LinearValidator:
    """Mean fold RMSE of elastic nets, for the searches of
    :mod:`voltide.operators.search`. ``folds`` must be a written table with
    ``fold`` and ``role``; it is read for the fold statistics and once for all
    matrices. A fold without training or test rows raises ``ValueError``."""

    def __init__(self, folds: DataFrame, features: Sequence[str], label: str, n_splits: int = CV_FOLDS, threads: int = 4):
        self.spark = folds.sparkSession
        self.trials: list[tuple] = []

        def prep(fold: int) -> Prep:
            rows = folds.where((F.col("fold") == fold) & (F.col("role") == "train") & F.col(label).isNotNull())
            return fit_prep(rows, features, label)

        with ThreadPoolExecutor(threads) as pool:
            preps = list(pool.map(prep, range(n_splits)))
        if any(p.n == 0 for p in preps):
            raise ValueError("a fold has no training rows")
        grams = fold_grams(folds, features, label, preps)
        self.train = [grams[f, "train"] for f in range(n_splits)]
        self.test = [grams[f, "test"] for f in range(n_splits)]
        if any(g[0, 0] == 0 for g in self.test):
            raise ValueError("a fold has no test rows")

    def rmse(self, batch: Sequence[Params]) -> np.ndarray:
        """RMSE ``[fold, candidate]``."""
        alpha = np.array([p["alpha"] for p in batch], dtype=float)
        ratio = np.array([p.get("l1_ratio", 0.0) for p in batch], dtype=float)
        b = elastic_net_paths(self.train, alpha, ratio)
        return np.array([rmse_from_gram(g, c) for g, c in zip(self.test, b)])

    def fresh(self) -> LinearValidator:
        """The same matrices without the trials made so far."""
        other = copy.copy(self)
        other.trials = []
        return other

    def untuned(self, alpha: float = 1e-3, l1_ratio: float = 0.5) -> float:
        """Mean fold RMSE of the library's default elastic net."""
        return float(self.rmse([{"alpha": alpha, "l1_ratio": l1_ratio}]).mean())

    def score(self, method: str, batch: Sequence[Params]) -> list[float]:
        start = time.time()
        scores = self.rmse(batch).mean(axis=0).tolist()
        seconds = (time.time() - start) / max(1, len(batch))
        done = sum(1 for t in self.trials if t[0] == method)
        self.trials += [
            (method, done + i, json.dumps(p, sort_keys=True), s, seconds) for i, (p, s) in enumerate(zip(batch, scores))
        ]
        return scores

    def trial_table(self) -> DataFrame:
        return trials_frame(self.spark, self.trials)

    def best(self, method: str) -> Params:
        return json.loads(min((t for t in self.trials if t[0] == method), key=lambda t: (t[3], t[1]))[2])
