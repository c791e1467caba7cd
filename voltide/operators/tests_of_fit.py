"""Residual diagnostics: White, BDS, Ljung-Box, Jarque-Bera, ACF, Q-Q."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltide.functions.scalars import chi2_tail, chi2_tail_even, normal_quantile, normal_two_sided, ratio
from voltide.plans.gram import gram_table, least_squares
from voltide.plans.layout import block_window, blocked, with_row_index, without_halo
from voltide.plans.ranking import bucket_of, running_totals
from voltide.session import materialize

KEYS = ("series_id", "model")


def residuals(preds: DataFrame) -> DataFrame:
    return preds.where(F.col("y_pred").isNotNull()).withColumn("e", F.col("y_true") - F.col("y_pred"))


def significance_stars(p: Column) -> Column:
    return (
        F.when(p.isNull(), "-").when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")
    )


def jarque_bera(preds: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Statistic, p-value, skewness and raw kurtosis (normal = 3)."""
    m = residuals(preds).groupBy(*keys).agg(
        F.count("e").alias("n"), F.skewness("e").alias("skew"), (F.kurtosis("e") + F.lit(3.0)).alias("kurtosis")
    )
    excess = F.col("kurtosis") - F.lit(3.0)
    stat = F.col("n") / F.lit(6.0) * (F.pow("skew", F.lit(2.0)) + F.pow(excess, F.lit(2.0)) / F.lit(4.0))
    return m.withColumn("statistic", stat).withColumn("p_value", chi2_tail_even(F.col("statistic"), 2))


def autocorrelations(preds: DataFrame, lags: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """``n`` and ``acf_1 .. acf_lags`` per group from one blocked pass."""
    e = with_row_index(residuals(preds).drop("row_idx", "n_rows"), keys=keys)
    means = e.groupBy(*keys).agg(F.avg("e").alias("_mean"))
    e = blocked(e, back=lags)
    w = block_window(keys)
    e = without_halo(e.withColumns({f"_l{k}": F.lag("e", k).over(w) for k in range(1, lags + 1)})).join(
        means, list(keys)
    )
    d = F.col("e") - F.col("_mean")
    sums = e.groupBy(*keys).agg(
        F.count("e").alias("n"),
        F.sum(d * d).alias("_sst"),
        *[F.sum(d * (F.col(f"_l{k}") - F.col("_mean"))).alias(f"_s{k}") for k in range(1, lags + 1)],
    )
    return sums.select(*keys, "n", *[ratio(f"_s{k}", "_sst").alias(f"acf_{k}") for k in range(1, lags + 1)])


def ljung_box(preds: DataFrame, lags: int = 10, keys: Sequence[str] = KEYS) -> DataFrame:
    acf = autocorrelations(preds, lags, keys)
    n = F.col("n")
    total: Column = F.lit(0.0)
    for k in range(1, lags + 1):
        total = total + F.pow(f"acf_{k}", F.lit(2.0)) / (n - F.lit(k))
    stat = (n * (n + F.lit(2))) * total
    return acf.select(*keys, F.lit(lags).alias("lags"), stat.alias("statistic")).withColumn(
        "p_value", chi2_tail_even(F.col("statistic"), lags) if lags % 2 == 0 else chi2_tail("statistic", "lags")
    )


def acf_points(preds: DataFrame, lags: int = 20, keys: Sequence[str] = KEYS) -> DataFrame:
    """Autocorrelation by lag with the 95% band, long form."""
    acf = autocorrelations(preds, lags, keys)
    long = acf.unpivot([*keys, "n"], [f"acf_{k}" for k in range(1, lags + 1)], "_name", "acf")
    lag = F.substring_index("_name", "_", -1).cast("int")
    return long.select(*keys, lag.alias("lag"), "acf", (F.lit(1.96) / F.sqrt("n")).alias("band"))


def qq_points(preds: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Ordered residuals with their plotting position and normal quantile."""
    counted = residuals(preds).groupBy(*keys, "e").agg(F.count(F.lit(1)).alias("_n"))
    placed = running_totals(counted, keys, "e", ["_n"])
    ranks = F.sequence(F.col("cum__n") - F.col("_n") + F.lit(1), F.col("cum__n"))
    points = placed.select(*keys, F.col("e").alias("sample"), "all__n", F.explode(ranks).alias("place"))
    points = points.withColumn("position", (F.col("place") - F.lit(0.5)) / F.col("all__n"))
    return points.select(*keys, "place", "sample", "position", normal_quantile("position").alias("theoretical"))


def white(
    preds: DataFrame, features: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS, max_features: int = 5
) -> DataFrame:
    """LM = n * R2 of squared residuals on features, squares and products.

    All sums of products are taken in one aggregation; only the small matrix
    of each group is solved outside the JVM."""
    used = list(columns)[:max_features]
    rows = residuals(preds).join(features.select("series_id", "date", *used), ["series_id", "date"]).dropna(subset=used)
    terms: list[Column] = [F.lit(1.0), *[F.col(c).cast("double") for c in used]]
    terms += [
        F.col(a).cast("double") * F.col(b).cast("double") for a, b in combinations_with_replacement(used, 2)
    ]
    design = rows.select(
        *keys, (F.col("e") * F.col("e")).alias("_y"), *[t.alias(f"_x{i}") for i, t in enumerate(terms)]
    )
    names = [f"_x{i}" for i in range(len(terms))]
    fit = least_squares(gram_table(design, names, "_y", keys), keys)
    stat = F.col("n") * F.col("r2")
    out = fit.select(*keys, "n", F.col("rank").alias("n_terms"), stat.alias("statistic"))
    return out.withColumn("p_value", chi2_tail("statistic", (F.col("n_terms") - 1).cast("double")))


#: Values that a bucket of a close-pair count wants, and cells of its count table at most.
BDS_ROWS, BDS_CELLS = 2048, 1 << 22


def close_counts(points: DataFrame, max_dim: int, eps: str, keys: Sequence[str], bucket_rows: int = BDS_ROWS) -> DataFrame:
    """``close1`` .. ``close<max_dim>`` of each row of ``keys, row_idx, e0 ..``: how
    many rows of its group (itself included) lie nearer than ``eps`` in the first m
    values.

    Values are cut into buckets by quantiles of the group. The range of a row around
    a value ends in two buckets, which are searched row by row; buckets between lie in it
    whole. So a row is compared with the rows of the two end buckets of each value in turn,
    where earlier values lie in whole buckets; and what lies in whole buckets in all
    values comes from running sums of a count table. Pairs are counted, never made."""
    import numpy as np
    import pandas as pd

    keys, dims = list(keys), range(max_dim)
    longest = points.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    buckets = 1
    while 2 * buckets <= longest / bucket_rows and (2 * buckets) ** max_dim <= min(BDS_CELLS, max(longest, 2**max_dim)):
        buckets *= 2
    shares = [i / buckets for i in range(1, buckets)] or [0.5]
    borders = points.groupBy(*keys).agg(F.percentile_approx("e0", shares, 10_000).alias("_borders"))
    at = lambda v: bucket_of(v, F.col("_borders"), buckets).cast("int") if buckets > 1 else F.when(v.isNotNull(), F.lit(0))
    values = [F.col(f"e{s}") for s in dims]
    cells = points.join(borders, keys).select(
        *keys, "row_idx", F.col(eps).alias("eps"), F.array(*values).alias("e"),
        *[F.transform(F.array(*[v + d for v in values]), lambda v: F.when(v.isNotNull(), at(v))).alias(n) for n, d in (("cell", 0.0), ("low", -F.col(eps)), ("high", F.col(eps)))],
    )
    cells = materialize(cells, "close-cells")
    places = F.array(*[F.struct(F.lit(s).alias("dim"), F.get("cell", s).alias("place")) for s in dims])
    ends = F.array(*[F.struct(F.lit(s).alias("dim"), F.get(n, s).alias("place")) for s in dims for n in ("low", "high")])
    own = cells.select("*", F.explode(places).alias("_p"), F.lit(False).alias("asks"))
    asking = cells.select("*", F.explode(F.array_distinct(ends)).alias("_p"), F.lit(True).alias("asks"))
    both = own.unionByName(asking).select("*", "_p.dim", "_p.place").where(F.col("place").isNotNull()).drop("_p")
    names = [f"close{m}" for m in range(1, max_dim + 1)]

    def table(group: pd.DataFrame, name: str) -> np.ndarray:
        return np.array([[np.nan if v is None else v for v in row] for row in group[name]], dtype=float).reshape(len(group), max_dim)

    def search(group: pd.DataFrame) -> pd.DataFrame:
        dim, asks = int(group["dim"].iloc[0]), group["asks"].to_numpy(bool)
        points_, queries = group[~asks], group[asks]
        e, cell = table(points_, "e"), table(points_, "cell")
        x, low, high, width = table(queries, "e"), table(queries, "low"), table(queries, "high"), queries["eps"].to_numpy(float)
        out = np.zeros((len(queries), max_dim), np.int64)
        for k in range(0, len(queries), 512):
            part = slice(k, k + 512)
            with np.errstate(invalid="ignore"):
                near = np.ones((len(x[part]), len(e)), bool)
                for s in range(dim):
                    near &= (cell[None, :, s] > low[part, s, None]) & (cell[None, :, s] < high[part, s, None])
                for s in range(dim, max_dim):
                    near &= np.abs(e[None, :, s] - x[part, s, None]) < width[part, None]
                    out[part, s] = near.sum(1)
        frame = queries[[*keys, "row_idx"]].reset_index(drop=True)
        for s, name in enumerate(names):
            frame[name] = out[:, s]
        return frame

    key_types = ", ".join(f"{k} {points.schema[k].dataType.simpleString()}" for k in keys)
    schema = f"{key_types}, row_idx long, " + ", ".join(f"{n} long" for n in names)
    counted = both.groupBy(*keys, "dim", "place").applyInPandas(search, schema)
    if buckets > 1:
        counts = cells.where(F.exists("cell", F.isnotnull)).groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("n"))
        # At most BDS_CELLS rows for each group.
        counts = counts.groupBy(*keys).agg(F.collect_list(F.struct("cell", "n")).alias("cells"))
        chunk = F.call_function("div", F.col("row_idx"), F.lit(bucket_rows).cast("long"))
        asked = cells.groupBy(*keys, chunk.alias("_chunk")).agg(F.collect_list(F.struct("row_idx", "low", "high")).alias("asked"))

        def whole(batches):
            for batch in batches:
                for r in batch.itertuples(index=False):
                    frame = pd.DataFrame({"row_idx": [q["row_idx"] for q in r.asked]})
                    for k, v in zip(keys, r[2:]):
                        frame[k] = v
                    low, high, cell = (np.array([[-1 if v is None or v != v else v for v in q[c]] for q in side], int) for side, c in ((r.asked, "low"), (r.asked, "high"), (r.cells, "cell")))
                    known = low >= 0
                    n = np.array([c["n"] for c in r.cells])
                    for m in range(1, max_dim + 1):
                        sums = np.zeros((buckets + 1,) * m, np.int64)
                        there = (cell[:, :m] >= 0).all(1)
                        np.add.at(sums, tuple(cell[there, s] + 1 for s in range(m)), n[there])
                        for s in range(m):
                            sums = sums.cumsum(axis=s)
                        total = np.zeros(len(low), np.int64)
                        for corner in range(1 << m):
                            # Buckets below the upper end, less those up to the lower one.
                            ends = [np.maximum(low[:, s] + 1, high[:, s]) if corner >> s & 1 else low[:, s] + 1 for s in range(m)]
                            total += (-1) ** (m - corner.bit_count()) * sums[tuple(np.clip(v, 0, buckets) for v in ends)]
                        frame[f"close{m}"] = np.where(known[:, :m].all(1), total, 0)
                    yield frame[[*keys, "row_idx", *names]]

        packed = asked.join(counts, keys).select("cells", "asked", *keys)
        counted = counted.unionByName(packed.mapInPandas(whole, schema))
    return counted.groupBy(*keys, "row_idx").agg(*[F.sum(n).alias(n) for n in names])


def _close_before(rows: Column):
    """Adds the earlier ones of ``rows`` that lie nearer than ``_eps`` to one."""
    return lambda total, x: total + F.size(
        F.filter(rows, lambda y: (y["row_idx"] < x["row_idx"]) & (F.abs(y["e"] - x["e"]) < F.col("_eps")))
    ).cast("double")


def bds(preds: DataFrame, max_dim: int = 3, distance: float = 1.5, keys: Sequence[str] = KEYS, bucket_rows: int = BDS_ROWS) -> DataFrame:
    """BDS statistic for dimensions 2 to ``max_dim``. Its correlation integrals come
    from :func:`close_counts`."""
    keys = list(keys)
    rows = with_row_index(residuals(preds).drop("row_idx", "n_rows"), keys=keys)
    spread = rows.groupBy(*keys).agg((F.stddev_samp("e") * F.lit(distance)).alias("eps"))
    w = block_window(keys)
    points = without_halo(
        blocked(rows, ahead=max_dim - 1).withColumns({f"e{s}": F.lead("e", s).over(w) for s in range(1, max_dim)})
    )
    points = points.join(spread, keys).withColumn("e0", F.col("e"))
    points = materialize(points.select(*keys, "row_idx", "eps", *[f"e{s}" for s in range(max_dim)]), "bds-points")
    close = close_counts(points, max_dim, "eps", keys, bucket_rows).join(points.select(*keys, "row_idx", "eps", "e0"), [*keys, "row_idx"])
    first = F.col("row_idx") < max_dim - 1
    r = F.col("close1").cast("double")
    total = close.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(r).alias("sum_r"),
        F.sum(r * r).alias("sum_r2"),
        *[F.sum(F.col(f"close{m}").cast("double")).alias(f"_all{m}") for m in range(1, max_dim + 1)],
        F.max("eps").alias("_eps"),
        F.sort_array(F.collect_list(F.when(first, F.struct("row_idx", F.col("e0").alias("e"), r.alias("r"))))).alias("_first"),
    )
    # A row counts itself once and each pair twice.
    total = total.withColumns({f"c{m}": (F.col(f"_all{m}") - (F.col("n") - (m - 1))) / 2 for m in range(1, max_dim + 1)})
    zero = F.lit(0.0)
    for m in range(2, max_dim + 1):
        head = F.slice("_first", 1, m - 1)
        pairs_of = F.aggregate(head, zero, lambda a, x: a + x["r"] - 1.0)
        inside = F.aggregate(head, zero, _close_before(head))
        total = total.withColumn(f"tail{m}", F.col("c1") - pairs_of + inside)
    n = F.col("n").cast("double")

    def pairs(size: Column) -> Column:
        return size * (size - F.lit(1.0)) / F.lit(2.0)

    c = ratio(F.col("c1"), pairs(n))
    k = ratio(F.col("sum_r2") - F.lit(3.0) * F.col("sum_r") + F.lit(2.0) * n, n * (n - 1) * (n - 2))
    total = total.withColumns({"_c": c, "_k": k})
    stats = []
    for m in range(2, max_dim + 1):
        size = n - F.lit(float(m - 1))
        c_m, c_1 = ratio(F.col(f"c{m}"), pairs(size)), ratio(F.col(f"tail{m}"), pairs(size))

        def power(base: str, e: int) -> Column:
            return F.pow(F.col(base), F.lit(float(e)))

        inner: Column = power("_k", m)
        for s in range(1, m):
            inner = inner + F.lit(2.0) * power("_k", m - s) * power("_c", 2 * s)
        inner = inner + F.lit(float((m - 1) ** 2)) * power("_c", 2 * m)
        inner = inner - F.lit(float(m * m)) * F.col("_k") * power("_c", 2 * m - 2)
        z = F.sqrt(size) * ratio(c_m - F.pow(c_1, F.lit(float(m))), F.sqrt(F.lit(4.0) * inner))
        stats.append(F.struct(F.lit(m).alias("dim"), z.alias("statistic")))
    long = total.select(*keys, F.explode(F.array(*stats)).alias("_s")).select(*keys, "_s.dim", "_s.statistic")
    return long.withColumn("p_value", normal_two_sided("statistic"))


def residual_diagnostics(
    preds: DataFrame, features: DataFrame, columns: Sequence[str], keys: Sequence[str] = KEYS, lags: int = 10
) -> DataFrame:
    """One row per group: mean and sample std of residuals, the p-values of
    the four tests with significance stars, skewness and kurtosis."""
    keys = list(keys)
    basic = residuals(preds).groupBy(*keys).agg(
        F.avg("e").alias("mean_residual"), F.stddev_samp("e").alias("std_residual")
    )
    jb = jarque_bera(preds, keys).select(*keys, "skew", "kurtosis", F.col("p_value").alias("p_jarque_bera"))
    lb = ljung_box(preds, lags, keys).select(*keys, F.col("p_value").alias("p_ljung_box"))
    wh = white(preds, features, columns, keys).select(*keys, F.col("p_value").alias("p_white"))
    bd = bds(preds, 2, keys=keys).where(F.col("dim") == 2).select(*keys, F.col("p_value").alias("p_bds_dim2"))
    # One row per group each: written, so that the four tests run one by one
    # instead of as one plan with several Python stages.
    wh, bd, lb = (materialize(t, "diagnostics") for t in (wh, bd, lb))
    out = basic.join(jb, keys).join(lb, keys).join(wh, keys, "left").join(bd, keys, "left")
    tests = ("white", "bds_dim2", "ljung_box", "jarque_bera")
    return out.withColumns({f"stars_{t}": significance_stars(F.col(f"p_{t}")) for t in tests})
