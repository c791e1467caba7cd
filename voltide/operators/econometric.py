"""ARIMA and GARCH(1,1) per series, built from distributed sums.

No series is ever collected: ARIMA reduces each series to one small matrix of
sums and computes blocks of its path apart, GARCH reduces each block of a series to
an affine map and a likelihood for each candidate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.plans.gram import gram_table, least_squares
from voltide.plans.layout import BLOCK_ROWS, block_window, blocked, with_row_index, without_halo
from voltide.session import materialize

LONG_AR = 10
MAX_P = MAX_Q = 3
#: Steps of a forecast path that one task row computes.
PATH_ROWS = 4096
#: Returns in percent; rounds of the grid, and how much narrower each is.
SCALE = 100.0
ROUNDS = 7
SHRINK = 0.5


def _lagged(df: DataFrame, columns: dict[str, int]) -> DataFrame:
    w = block_window()
    lags = {f"{c}_{k}": F.lag(c, k).over(w) for c, n in columns.items() for k in range(1, n + 1)}
    return without_halo(blocked(df, back=max(columns.values())).withColumns(lags))


def fit_arima(history: DataFrame, value: str, max_p: int = MAX_P, max_q: int = MAX_Q) -> DataFrame:
    """ARIMA(p,1,q) by two least-squares passes (Hannan-Rissanen): a long
    autoregression gives residuals, then lags of the differences and of the
    residuals are regressed together. Order by AIC from one matrix of sums.

    Columns: order ``p, q``, ``const``, ``ar``, ``ma``, ``aic``, last values.
    """
    import numpy as np
    import pandas as pd

    rows = with_row_index(history.drop("row_idx", "n_rows").where(F.col(value).isNotNull()))
    rows = rows.select("series_id", "date", "row_idx", "n_rows", F.col(value).cast("double").alias("y"))
    w = block_window()
    diff = without_halo(blocked(rows, back=1).withColumn("z", F.col("y") - F.lag("y", 1).over(w)))
    long = _lagged(diff, {"z": LONG_AR}).withColumn("one", F.lit(1.0))
    names = ["one", *[f"z_{k}" for k in range(1, LONG_AR + 1)]]
    first = least_squares(gram_table(long, names, "z", ["series_id"]), ["series_id"]).select("series_id", "beta")
    fitted: Column = F.get("beta", 0)
    for k in range(1, LONG_AR + 1):
        fitted = fitted + F.get("beta", k) * F.col(f"z_{k}")
    shocks = long.join(first, "series_id").withColumn("u", F.col("z") - fitted)
    both = _lagged(shocks.select("series_id", "row_idx", "n_rows", "y", "z", "u"), {"z": max_p, "u": max_q})
    terms = ["one", *[f"z_{k}" for k in range(1, max_p + 1)], *[f"u_{k}" for k in range(1, max_q + 1)]]
    gram = gram_table(both.withColumn("one", F.lit(1.0)), terms, "z", ["series_id"])
    depth = max(max_p, max_q)
    tail = (
        both.where(F.col("row_idx") >= F.col("n_rows") - depth)
        .groupBy("series_id")
        .agg(
            F.transform(F.sort_array(F.collect_list(F.struct("row_idx", "z")), False), lambda s: s["z"]).alias("last_z"),
            F.transform(F.sort_array(F.collect_list(F.struct("row_idx", "u")), False), lambda s: s["u"]).alias("last_u"),
            F.max_by("y", "row_idx").alias("last_y"),
        )
    )

    def choose(batches):
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                xy = np.asarray(r.xy, dtype=float)
                m = len(xy)
                full = np.zeros((m, m))
                full[np.triu_indices(m)] = np.asarray(r.xx, dtype=float)
                full = full + np.triu(full, 1).T
                best = None
                for p in range(max_p + 1):
                    for q in range(max_q + 1):
                        use = [0, *range(1, p + 1), *range(max_p + 1, max_p + q + 1)]
                        sub, rhs = full[np.ix_(use, use)], xy[use]
                        scale = np.sqrt(np.where(np.diag(sub) > 0, np.diag(sub), 1.0))
                        beta = np.linalg.lstsq(sub / np.outer(scale, scale), rhs / scale, rcond=1e-12)[0] / scale
                        sse = max(r.yy - 2 * beta @ rhs + beta @ sub @ beta, 1e-300)
                        aic = r.n * np.log(sse / r.n) + 2 * len(use)
                        if best is None or aic < best[0]:
                            best = (aic, p, q, beta)
                aic, p, q, beta = best
                out.append((r.series_id, p, q, float(beta[0]), beta[1 : p + 1].tolist(), beta[p + 1 :].tolist(), float(aic)))
            yield pd.DataFrame(out, columns=["series_id", "p", "q", "const", "ar", "ma", "aic"])

    schema = "series_id string, p int, q int, const double, ar array<double>, ma array<double>, aic double"
    return gram.mapInPandas(choose, schema).join(tail, "series_id")


def _step_matrix(const: float, ar: Sequence[float], ma: Sequence[float]):
    """One step of the forecast as a matrix over (last changes, last shocks, level,
    1); shocks to come are 0."""
    import numpy as np

    size = MAX_P + MAX_Q + 2
    change = np.zeros(size)
    change[: len(ar)], change[MAX_P : MAX_P + len(ma)], change[-1] = ar, ma, const
    step = np.zeros((size, size))
    step[0] = change
    for k in range(1, MAX_P):
        step[k, k - 1] = 1.0
    for k in range(MAX_P + 1, MAX_P + MAX_Q):
        step[k, k - 1] = 1.0
    step[-2] = change
    step[-2, -2] = step[-1, -1] = 1.0
    return step


def arima_path(fits: DataFrame) -> DataFrame:
    """``series_id``, ``row_idx``, ``y_pred``: the forecasts of ``n_steps`` steps of
    each row of ``const, ar, ma, last_z, last_u, last_y`` (latest first).

    The steps are cut into blocks. A power of the step matrix leads straight to
    the start of a block, doubling fills it: no step waits for the one before."""
    import numpy as np
    import pandas as pd

    def path(batches):
        for batch in batches:
            for r in batch.itertuples(index=False):
                step = _step_matrix(r.const, r.ar, r.ma)
                start = np.zeros(len(step))
                start[: len(r.last_z)], start[MAX_P : MAX_P + len(r.last_u)] = r.last_z, r.last_u
                start[-2:] = r.last_y, 1.0
                with np.errstate(all="ignore"):
                    states = (np.linalg.matrix_power(step, r.block * PATH_ROWS + 1) @ start)[:, None]
                    size = min(PATH_ROWS, r.n_steps - r.block * PATH_ROWS)
                    power = step
                    while states.shape[1] < size:
                        states = np.hstack([states, power @ states])
                        power = power @ power
                rows = r.block * PATH_ROWS + np.arange(size)
                yield pd.DataFrame({"series_id": r.series_id, "row_idx": rows, "y_pred": states[-2, :size]})

    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("n_steps").cast("long") - 1, F.lit(PATH_ROWS).cast("long"))))
    cut = fits.where(F.col("n_steps") > 0).select("series_id", "const", "ar", "ma", "last_z", "last_u", "last_y", "n_steps", blocks.alias("block"))
    return cut.repartition("series_id", "block").mapInPandas(path, "series_id string, row_idx long, y_pred double")


def arima_forecasts(history: DataFrame, test: DataFrame, value: str) -> DataFrame:
    """Forecast path over the test rows of each series. A series too short to
    fit gets its mean."""
    ahead = with_row_index(test.drop("row_idx", "n_rows"))
    steps = ahead.groupBy("series_id").agg(F.max("n_rows").alias("n_steps"))
    paths = arima_path(fit_arima(history, value).join(steps, "series_id"))
    mean = history.groupBy("series_id").agg(F.avg(value).alias("_mean"))
    out = ahead.join(paths, ["series_id", "row_idx"], "left").join(mean, "series_id")
    y_pred = F.coalesce(F.when(~F.isnan("y_pred"), F.col("y_pred")), F.col("_mean"))
    return out.select("series_id", "date", F.lit("ARIMA").alias("model"), F.col(value).alias("y_true"), y_pred.alias("y_pred"))


def garch_blocks(history: DataFrame, returns: str = "log_ret") -> DataFrame:
    """One row for each block of a series: scaled returns less their mean in order
    (``e``), the variance of the series, and whether the block is its last."""
    rows = with_row_index(history.drop("row_idx", "n_rows").where(F.col(returns).isNotNull()))
    scaled = F.col(returns) * SCALE
    stats = rows.groupBy("series_id").agg(F.avg(scaled).alias("mu"), F.var_samp(scaled).alias("var"))
    rows = rows.join(stats, "series_id").withColumn("block", F.call_function("div", F.col("row_idx").cast("long"), F.lit(BLOCK_ROWS).cast("long")))
    pairs = F.sort_array(F.collect_list(F.struct("row_idx", (scaled - F.col("mu")).alias("e"))))
    return rows.groupBy("series_id", "block").agg(
        F.first("var").alias("var"), F.transform(pairs, lambda p: p["e"]).alias("e"), (F.max("row_idx") == F.max("n_rows") - 1).alias("is_last")
    )


def _decayed_squares(e, betas):
    """Sums of squares so far, each weighted by beta for every later row, before
    each row and after the last one: rows + 1 by betas."""
    import numpy as np

    out = np.zeros((len(e) + 1, len(betas)))
    now = out[0]
    for t, square in enumerate(np.asarray(e, float) ** 2, 1):
        now = now * betas + square
        out[t] = now
    return out


def garch_likelihood(blocks: DataFrame, candidates: DataFrame) -> DataFrame:
    """``nll`` and ``next_variance`` of every row of ``candidates`` (``series_id,
    level, alpha, beta``) over the whole of its series; ``omega`` is level x variance
    x (1 - alpha - beta).

    The variance of a row is an affine map of that of the row before, so a block of
    n rows is one too: beta ** n, and a constant that needs one decayed sum of squares
    for each beta. The maps of the blocks, a table as many times smaller as a block
    has rows, are composed in order; with the variance at its start each block
    then gives its part of the likelihood."""
    import numpy as np
    import pandas as pd

    point = F.struct("level", "alpha", "beta")
    grid = candidates.groupBy("series_id").agg(F.sort_array(F.collect_set(point)).alias("grid"))

    def columns(r):
        level, alpha, beta = np.array([(p["level"], p["alpha"], p["beta"]) for p in r.grid]).T
        betas, place = np.unique(beta, return_inverse=True)
        return level * r.var * (1.0 - alpha - beta), alpha, beta, betas, place

    def maps(batches):
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                omega, alpha, beta, betas, place = columns(r)
                n = len(r.e)
                squares = _decayed_squares(r.e, betas)[-1][place]
                power = beta**n
                constant = omega * np.where(beta < 1.0, (1.0 - power) / np.where(beta < 1.0, 1.0 - beta, 1.0), n) + alpha * squares
                out.append((r.series_id, r.block, r.var, power, constant))
            yield pd.DataFrame(out, columns=["series_id", "block", "var", "power", "constant"])

    def compose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("block")
        variance, starts = np.full(len(group["power"].iloc[0]), group["var"].iloc[0]), []
        for power, constant in zip(group["power"], group["constant"]):
            starts.append(variance)
            variance = power * variance + constant
        return pd.DataFrame({"series_id": group["series_id"], "block": group["block"], "start": starts})

    def likelihood(batches):
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                omega, alpha, beta, betas, place = columns(r)
                e = np.asarray(r.e, float)
                squares, nll = _decayed_squares(e, betas), np.zeros(len(beta))
                start = np.asarray(r.start, float)
                for first in range(0, len(e) + 1, 256):
                    t = np.arange(first, min(first + 256, len(e) + 1))[:, None]
                    power = betas[None, :] ** t
                    series = np.where(betas < 1.0, (1.0 - power) / np.where(betas < 1.0, 1.0 - betas, 1.0), t)
                    variance = power[:, place] * start + omega * series[:, place] + alpha * squares[t[:, 0]][:, place]
                    own = variance[: len(e) - first]
                    nll += 0.5 * (np.log(2.0 * np.pi * own) + (e[first : first + len(own)] ** 2)[:, None] / own).sum(0)
                out.append((r.series_id, r.grid, omega, nll, variance[-1] if r.is_last else np.full(len(beta), np.nan)))
            yield pd.DataFrame(out, columns=["series_id", "grid", "omega", "nll", "next_variance"])

    kind = "array<struct<level:double,alpha:double,beta:double>>"
    work = materialize(blocks.join(grid, "series_id"), "garch-blocks")
    composed = work.select("series_id", "block", "var", "e", "grid").mapInPandas(maps, "series_id string, block long, var double, power array<double>, constant array<double>")
    starts = composed.groupBy("series_id").applyInPandas(compose, "series_id string, block long, start array<double>")
    parts = work.join(starts, ["series_id", "block"]).select("series_id", "var", "e", "is_last", "grid", "start")
    parts = parts.mapInPandas(likelihood, f"series_id string, grid {kind}, omega array<double>, nll array<double>, next_variance array<double>")
    each = parts.select("series_id", F.explode(F.arrays_zip("grid", "omega", "nll", "next_variance")).alias("p"))
    each = each.select("series_id", "p.grid.level", "p.grid.alpha", "p.grid.beta", "p.omega", "p.nll", F.nanvl("p.next_variance", F.lit(None).cast("double")).alias("next_variance"))
    return each.groupBy("series_id", "level", "alpha", "beta", "omega").agg(F.sum("nll").alias("nll"), F.max("next_variance").alias("next_variance"))


def _grid(best: DataFrame, width: float) -> DataFrame:
    """Candidates around the best point of each series: alpha from 0 to 1, beta by
    the distance of alpha + beta from 1 on a scale of logarithms."""
    step = lambda n: F.explode(F.sequence(F.lit(-n), F.lit(n)))
    wide = best.withColumn("_i", step(3)).withColumn("_j", step(3)).withColumn("_k", step(1))
    moved = lambda c, k, size: F.col(c) + F.lit(size * width) * F.col(k) / 3.0
    alpha = F.exp(F.least(F.lit(-0.01), moved("_log_alpha", "_i", 2.5)))
    gap = F.exp(F.least(F.lit(-0.001), moved("_log_gap", "_j", 3.5)))
    level = F.exp(F.col("_log_level") + F.lit(0.7 * width) * F.col("_k"))
    out = wide.select("series_id", level.alias("level"), alpha.alias("alpha"), (1.0 - gap - alpha).alias("beta"))
    return out.where(F.col("beta") >= 0.0)


def fit_garch(history: DataFrame, returns: str = "log_ret", rounds: int = ROUNDS) -> DataFrame:
    """GARCH(1,1) with constant mean by maximum likelihood on a grid that is
    refined around the best point of each series (Bollerslev 1986); neither alpha nor
    beta nor the level is capped.

    Columns: ``omega, alpha, beta, nll, next_variance`` (scaled returns)."""
    blocks = materialize(garch_blocks(history, returns), "garch-returns")
    start = blocks.select("series_id").distinct()
    best = start.select("series_id", F.lit(0.0).alias("_log_level"), F.lit(-2.5).alias("_log_alpha"), F.lit(-3.0).alias("_log_gap"))
    found = None
    for i in range(rounds):
        scored = garch_likelihood(blocks, _grid(best, SHRINK**i))
        if found is not None:
            scored = scored.unionByName(found)
        point = F.struct("nll", "level", "alpha", "beta", "omega", "next_variance")
        found = scored.groupBy("series_id").agg(F.min(point).alias("_b")).select("series_id", "_b.*")
        found = materialize(found, "garch-best")
        best = found.select(
            "series_id", F.log("level").alias("_log_level"), F.log("alpha").alias("_log_alpha"), F.log(1.0 - F.col("alpha") - F.col("beta")).alias("_log_gap")
        )
    return found


def garch_forecasts(history: DataFrame, test: DataFrame, value: str, returns: str = "log_ret") -> DataFrame:
    """Multi-step volatility path: variance returns to its long-run level at
    rate alpha + beta. A series without a fit gets its return std."""
    fits = fit_garch(history, returns)
    spread = history.groupBy("series_id").agg(F.stddev_samp(returns).alias("_std"))
    ahead = with_row_index(test.drop("row_idx", "n_rows")).join(spread, "series_id").join(fits, "series_id", "left")
    rate = F.col("alpha") + F.col("beta")
    long_run = F.try_divide(F.col("omega"), F.lit(1.0) - rate)
    variance = long_run + F.pow(rate, F.col("row_idx").cast("double")) * (F.col("next_variance") - long_run)
    sigma = F.coalesce(F.sqrt(F.when(variance >= 0, variance)) / F.lit(SCALE), F.col("_std"))
    return ahead.select(
        "series_id", "date", F.lit("GARCH(1,1)").alias("model"), F.col(value).alias("y_true"), sigma.alias("y_pred")
    )


def econometric_forecasts(
    history: DataFrame, test: DataFrame, value: str, returns: str = "log_ret", models: Sequence[str] = ("ARIMA", "GARCH(1,1)")
) -> DataFrame:
    makers = {"ARIMA": lambda: arima_forecasts(history, test, value), "GARCH(1,1)": lambda: garch_forecasts(history, test, value, returns)}
    out = None
    for m in models:
        one = makers[m]()
        out = one if out is None else out.unionByName(one)
    return out
