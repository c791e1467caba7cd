"""Least squares from sums of products.

The data rows are reduced to one small matrix per group by ordinary partial
aggregation; only that matrix reaches Python.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gram_table(df: DataFrame, x: Sequence[str], y: str, keys: Sequence[str], weight: str | None = None) -> DataFrame:
    """``n``, ``yy``, ``y_sum``, ``w_sum``, ``xy`` (array) and the upper
    triangle ``xx`` (array) per group."""
    w = f"`{weight}` * " if weight else ""
    rows = df.dropna(subset=[*x, y])
    m = len(x)
    upper = [(i, j) for i in range(m) for j in range(i, m)]
    # SQL text keeps building some hundred sums cheap on the driver.
    sums = [f"sum({w}`{c}` * `{y}`) AS _xy_{i}" for i, c in enumerate(x)]
    sums += [f"sum({w}`{x[i]}` * `{x[j]}`) AS _xx_{i}_{j}" for i, j in upper]
    sums += [f"sum({w}`{y}`) AS y_sum", f"sum({w}`{y}` * `{y}`) AS yy", f"sum({w}1.0D) AS w_sum", "count(1) AS n"]
    xy = ", ".join(f"_xy_{i}" for i in range(m))
    xx = ", ".join(f"_xx_{i}_{j}" for i, j in upper)
    return (
        rows.groupBy(*keys)
        .agg(*[F.expr(t) for t in sums])
        .selectExpr(*keys, "n", "w_sum", "y_sum", "yy", f"array({xy}) AS xy", f"array({xx}) AS xx")
    )


def least_squares(gram: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coefficients, SSE, R2 (about the mean) and rank of each group."""
    import numpy as np
    import pandas as pd

    keys = list(keys)

    def solve(batches):
        for batch in batches:
            rows = []
            for r in batch.itertuples(index=False):
                xy = np.asarray(r.xy, dtype=float)
                m = len(xy)
                full = np.zeros((m, m))
                full[np.triu_indices(m)] = np.asarray(r.xx, dtype=float)
                full = full + np.triu(full, 1).T
                scale = np.sqrt(np.where(np.diag(full) > 0, np.diag(full), 1.0))
                beta, _, rank, _ = np.linalg.lstsq(full / np.outer(scale, scale), xy / scale, rcond=1e-13)
                beta = beta / scale
                sse = max(r.yy - 2 * beta @ xy + beta @ full @ beta, 0.0)
                sst = r.yy - r.y_sum**2 / r.w_sum
                rows.append(
                    (*[getattr(r, k) for k in keys], r.n, beta.tolist(), sse, 1 - sse / sst if sst > 0 else None, int(rank))
                )
            yield pd.DataFrame(rows, columns=[*keys, "n", "beta", "sse", "r2", "rank"])

    types = [f"{k} {gram.schema[k].dataType.simpleString()}" for k in keys]
    schema = ", ".join([*types, "n long", "beta array<double>", "sse double", "r2 double", "rank int"])
    return gram.mapInPandas(solve, schema)
