"""k-nearest-neighbour join, exact or by locality-sensitive hashing.

Exact (``nearest_neighbours``): training rows are put into cells around a few
pivot rows. A query row first looks into its own cell, which bounds the distance
of its k-th neighbour, and then only into cells that can hold a closer row. Cells
are compared in tiles of fixed size, and a tile returns ``k`` rows per query: no
pair table exists. Without structure in the data the work is quadratic.

Approximate (``lsh_neighbours``): rows meet where their bucketed random
projections agree in one of several hash tables; the rows met are ranked by exact
distance. Bucket width and numbers of projections and tables come from a bounded
sample, so that buckets keep about ``BUCKET_ROWS`` rows however many there are and
near rows still meet. A bucket that is larger all the same is cut by further
projections.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.feature import BucketedRandomProjectionLSH
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltide.functions.scalars import hash_uniform
from voltide.session import materialize
from voltide.settings import SEED

PIVOTS = 32
TILE = 4096
#: Training rows up to which pivots save nothing.
SMALL = 2 * TILE
NEIGHBOURS = 11
#: Rows that an approximate search wants in a bucket.
BUCKET_ROWS = 1024
#: A bucket of so many times that is cut once more.
OVERFULL = 8
#: Rows of the sample that plans the hashing, and queries among them.
SAMPLE_ROWS, SAMPLE_QUERIES = 4096, 256
#: Share of near rows that must meet in the sample.
RECALL = 0.98
MAX_TABLES, MAX_PROJECTIONS = 48, 12


def _with_pivots(df: DataFrame, pivots: list[list[float]]) -> DataFrame:
    import numpy as np


    base = np.asarray(pivots, dtype=float)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def distances(v: pd.Series) -> pd.Series:
        x = np.stack(v.to_numpy())
        out = np.empty((len(x), len(base)))
        for j, p in enumerate(base):
            out[:, j] = np.sqrt(((x - p) ** 2).sum(axis=1))
        return pd.Series(list(out))

    df = df.withColumn("_to_pivot", distances("v"))
    nearest = F.array_min("_to_pivot")
    return df.withColumns(
        {"cell": (F.array_position("_to_pivot", nearest) - F.lit(1)).cast("int"), "_r": nearest}
    )


def _tile_top_k(queries: DataFrame, train: DataFrame, k: int, few_cells: bool = True) -> DataFrame:
    """Best ``k`` training rows per query inside the cells it was sent to."""
    import numpy as np


    def tiles(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(TILE))).cast("int").alias(name))

    sizes = tiles(queries, "_nq").join(tiles(train, "_nt"), "cell")
    if few_cells:  # two counts per cell: a table of at most PIVOTS rows
        sizes = F.broadcast(sizes)

    def side(df: DataFrame, own: str, other: str, is_query: bool) -> DataFrame:
        salt = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        spread = F.explode(F.sequence(F.lit(0), F.col(other) - F.lit(1)))
        df = df.select("cell", "id", "v", "y").join(sizes, "cell").withColumn("_mine", salt)
        df = df.withColumn("_theirs", spread)
        q, t = ("_mine", "_theirs") if is_query else ("_theirs", "_mine")
        return df.select("cell", F.col(q).alias("qt"), F.col(t).alias("tt"), "id", "v", "y", F.lit(is_query).alias("is_query"))

    both = side(queries, "_nq", "_nt", True).unionByName(side(train, "_nt", "_nq", False))

    def best(group: pd.DataFrame) -> pd.DataFrame:
        q, t = group[group["is_query"]], group[~group["is_query"]]
        columns = {"qid": [], "tid": [], "distance": [], "y": []}
        if len(q) and len(t):
            a, b = np.stack(q["v"].to_numpy()), np.stack(t["v"].to_numpy())
            names, targets = t["id"].to_numpy(), t["y"].to_numpy(float)
            b2 = (b * b).sum(axis=1)
            place = np.argsort(np.argsort(names))
            take = min(k, len(b))
            for start in range(0, len(a), 64):
                part, asked = a[start : start + 64], q["id"].to_numpy()[start : start + 64]
                a2 = (part * part).sum(axis=1)
                rough = b2[None, :] - 2.0 * part @ b.T
                # All rows that rounding lets be as near as the k-th, ties included.
                last = np.partition(rough, take - 1, axis=1)[:, take - 1]
                slack = 1e-9 * (a2 + b2.max() + 1.0)
                i, j = np.nonzero(rough <= (last + slack)[:, None])
                exact = np.concatenate([np.sqrt(((b[j[c : c + 65_536]] - part[i[c : c + 65_536]]) ** 2).sum(axis=1)) for c in range(0, len(i), 65_536)])
                order = np.lexsort((place[j], exact, i))
                i, j, exact = i[order], j[order], exact[order]
                nth = np.arange(len(i)) - np.searchsorted(i, i)
                keep = nth < k
                columns["qid"] += list(asked[i[keep]])
                columns["tid"] += list(names[j[keep]])
                columns["distance"] += list(exact[keep])
                columns["y"] += list(targets[j[keep]])
        return pd.DataFrame(columns)

    return both.groupBy("cell", "qt", "tt").applyInPandas(best, "qid string, tid string, distance double, y double")


def _keep_best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy("distance", "tid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def vectors(df: DataFrame, features: Sequence[str], label: str | None = None) -> DataFrame:
    """``(id, v, y)`` rows; the id is series and date."""
    return df.select(
        F.concat_ws("|", F.col("series_id"), F.col("date").cast("string")).alias("id"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("v"),
        (F.col(label).cast("double") if label else F.lit(None).cast("double")).alias("y"),
    )


def nearest_neighbours(queries: DataFrame, train: DataFrame, k: int, pivots: int = PIVOTS) -> DataFrame:
    """``(qid, tid, distance, y, rank)`` for tables of :func:`vectors`."""
    if train.limit(SMALL + 1).count() <= SMALL:  # one cell; tiles of queries only
        whole = lambda df: df.withColumn("cell", F.lit(0))
        return _keep_best(_tile_top_k(whole(queries), whole(train), k), k)
    chosen = train.orderBy(F.md5(F.concat_ws(",", "id", F.lit(str(SEED)))), "id").limit(pivots)
    base = [r["v"] for r in chosen.select("v").collect()]
    t, q = _with_pivots(train, base), _with_pivots(queries, base)
    first = _keep_best(_tile_top_k(q, t, k), k)
    bound = first.groupBy("qid").agg(F.when(F.count(F.lit(1)) == k, F.max("distance")).alias("_bound"))
    radius = t.groupBy("cell").agg(F.max("_r").alias("_radius"))
    radii = F.broadcast(radius.agg(F.collect_list(F.struct("cell", "_radius")).alias("_radii")))
    wider = q.join(bound, q["id"] == bound["qid"], "left").drop("qid").join(radii)
    slack = F.lit(1.0 + 1e-9)
    reachable = F.filter(
        "_radii",
        lambda c: (c["cell"] != F.col("cell"))
        & F.coalesce(F.get(F.col("_to_pivot"), c["cell"]) - c["_radius"] <= F.col("_bound") * slack, F.lit(True)),
    )
    wider = wider.select("id", "v", "y", F.explode(F.transform(reachable, lambda c: c["cell"])).alias("cell"))
    second = _tile_top_k(wider, t, k)
    return _keep_best(first.drop("rank").unionByName(second), k)


@dataclass(frozen=True)
class HashPlan:
    """``tables`` hash tables of ``projections`` projections each, in buckets of
    ``width``; ``met`` is the share of near rows of the sample that meet."""

    width: float
    projections: int
    tables: int
    met: float


def plan_hashing(sample, n_rows: int, k: int, recall: float = RECALL, bucket_rows: int = BUCKET_ROWS) -> HashPlan | None:
    """The plan with the fewest comparisons by which near rows of the sample
    meet; None if none does with fewer than comparing all rows."""
    import numpy as np

    rng = np.random.RandomState(SEED)
    asked = sample[: min(SAMPLE_QUERIES, len(sample))]
    square = (asked**2).sum(1)[:, None] + (sample**2).sum(1)[None, :] - 2 * asked @ sample.T
    square[np.arange(len(asked)), np.arange(len(asked))] = np.inf
    # The k-th neighbour of all rows is about this place among those of the sample.
    near = min(len(sample) - 1, max(1, round(k * len(sample) / n_rows)))
    found = np.argsort(square, axis=1)[:, :near]
    scale = float(np.median(np.sqrt(np.maximum(np.take_along_axis(square, found[:, -1:], 1), 0.0)))) or 1.0
    directions = rng.normal(size=(sample.shape[1], MAX_TABLES * MAX_PROJECTIONS))
    directions /= np.linalg.norm(directions, axis=0)
    all_at, own_at = sample @ directions, asked @ directions
    other = rng.randint(0, len(sample), (len(asked), 64))
    best = None
    for share in (0.25, 0.5, 1.0, 2.0, 4.0):
        width = share * scale
        own, every = np.floor(own_at / width), np.floor(all_at / width)
        same_near = (own[:, None, :] == every[found]).reshape(len(asked), near, MAX_TABLES, MAX_PROJECTIONS)
        same_far = (own[:, None, :] == every[other]).reshape(len(asked), 64, MAX_TABLES, MAX_PROJECTIONS)
        for projections in range(1, MAX_PROJECTIONS + 1):
            far = same_far[..., :projections].all(-1).mean()
            hit = np.maximum.accumulate(same_near[..., :projections].all(-1), axis=-1).mean((0, 1))
            enough = np.flatnonzero(hit >= recall)
            if not len(enough):
                continue
            tables = int(enough[0]) + 1
            cost = tables * max(far * n_rows, min(bucket_rows, n_rows) / 4)
            if cost < n_rows and (best is None or cost < best[0]):
                best = (cost, HashPlan(float(width), projections, tables, float(hit[tables - 1])))
    return best and best[1]


def _bucket_keys(hashed: DataFrame, plan: HashPlan, columns: Sequence[str], depth: int) -> DataFrame:
    """A row for each table: ``cell`` is the hash of its projections, ``fine``
    that of as many of the next table besides."""
    p, n = plan.projections, plan.projections * plan.tables

    def key(table: int, width: int) -> Column:
        at = [F.get("_h", F.lit((table * p + i) % n)) for i in range(width)]
        return F.xxhash64(F.lit(table), F.lit(width), *at)

    tables = F.array(*[F.struct(key(t, p).alias("cell"), key(t, depth).alias("fine")) for t in range(plan.tables)])
    return hashed.select(*columns, F.explode(tables).alias("_k")).select(*columns, "_k.cell", "_k.fine")


def lsh_neighbours(queries: DataFrame, train: DataFrame, k: int, recall: float = RECALL) -> DataFrame:
    """``(qid, tid, distance, y, rank)`` as ``nearest_neighbours``, but rows that
    share no bucket are not compared. Without a plan that saves comparisons
    (small or shapeless tables) the exact join answers."""
    import numpy as np

    n_rows = train.count()
    share = min(1.0, 1.1 * SAMPLE_ROWS / max(n_rows, 1))
    drawn = train.where(hash_uniform("id", F.lit("sample"), SEED) < share).select("v").limit(2 * SAMPLE_ROWS).collect()
    plan = plan_hashing(np.array([r["v"] for r in drawn], float), n_rows, k, recall) if len(drawn) > k else None
    if plan is None:
        return nearest_neighbours(queries, train, k)
    hashing = BucketedRandomProjectionLSH(
        inputCol="_v", outputCol="_hashes", bucketLength=plan.width, numHashTables=plan.projections * plan.tables, seed=SEED
    )
    as_vector = lambda df: df.withColumn("_v", array_to_vector("v"))
    model = hashing.fit(as_vector(train))
    depth = min(2 * plan.projections, plan.projections * plan.tables)

    def keyed(df: DataFrame) -> DataFrame:
        hashed = model.transform(as_vector(df)).withColumn("_h", F.transform("_hashes", lambda h: F.get(vector_to_array(h), 0)))
        return _bucket_keys(hashed, plan, ("id", "v", "y"), depth)

    t, q = materialize(keyed(train), "train-buckets"), materialize(keyed(queries), "query-buckets")
    full = t.groupBy("cell").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > OVERFULL * BUCKET_ROWS).select("cell", F.lit(True).alias("_full"))
    cut = lambda df: df.join(full, "cell", "left").withColumn("cell", F.when(F.col("_full"), F.col("fine")).otherwise(F.col("cell")))
    found = _tile_top_k(cut(q), cut(t), k, few_cells=False)
    return _keep_best(found.dropDuplicates(["qid", "tid"]), k)


def neighbour_join(queries: DataFrame, train: DataFrame, k: int, mode: str = "exact") -> DataFrame:
    if mode not in ("exact", "lsh"):
        raise ValueError("mode must be 'exact' or 'lsh'")
    return nearest_neighbours(queries, train, k) if mode == "exact" else lsh_neighbours(queries, train, k)


def knn_predict(
    train: DataFrame, test: DataFrame, features: Sequence[str], label: str, k: int = NEIGHBOURS, mode: str = "exact"
) -> DataFrame:
    """Mean label of the ``k`` nearest training rows (a class share for 0/1)."""
    found = neighbour_join(vectors(test, features, label), vectors(train, features, label), k, mode)
    mean = found.groupBy("qid").agg(F.avg("y").alias("y_pred"))
    rows = test.select(
        "series_id",
        "date",
        F.col(label).cast("double").alias("y_true"),
        F.concat_ws("|", F.col("series_id"), F.col("date").cast("string")).alias("qid"),
    )
    return rows.join(mean, "qid").select("series_id", "date", F.lit("KNN").alias("model"), "y_true", "y_pred")
