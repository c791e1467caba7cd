"""Bootstrap replicates as weights of rows.

A replicate draws as many rows as there are, with replacement. Rows are numbered
and cut into buckets of ``BUCKET_ROWS``. First only the number of draws of each
replicate in each bucket is drawn, a table of replicates x buckets; then each
bucket draws that many of its own rows. So a row knows how often every
replicate has it, and no copy of a row is made and no draw meets a row in a join.

``poisson`` gives each row an independent Poisson(1) number in each replicate
instead; it needs no counts and is the choice for very large tables.

Draws are a fixed arithmetic hash of seed, replicate and place, so they repeat on
any engine.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltide.plans.layout import with_row_index
from voltide.plans.ranking import BUCKET, with_bucket
from voltide.session import materialize

BUCKET_ROWS = 4096
#: Draws that one task row makes when bucket counts are drawn.
CHUNK_DRAWS = 1 << 20
#: Replicates whose weights of a bucket are made at a time.
REPS_AT_ONCE = 256
#: Place of a draw inside a bucket: bits below those of the bucket's number.
PLACE_BITS = 20
MASK = 0xFFFFFFFF
# Multipliers below 2 ** 31, so that products fit 63 bits on any engine.
FACTORS = (0x7FEB352D, 0x5BD1E995)
HIGH_FACTOR = 0x3779B97F
REP_FACTOR = 0x2545F491
#: Streams of draws: bucket of a draw (two words), row in the bucket, Poisson.
BUCKET_HIGH, BUCKET_LOW, ROW, POISSON = 1, 2, 3, 4


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> 16)) * FACTORS[0] & MASK
    x = (x ^ (x >> 15)) * FACTORS[1] & MASK
    return x ^ (x >> 16)


def hash_of(seed: int, stream: int, rep: np.ndarray, place: np.ndarray) -> np.ndarray:
    """32-bit hashes (arrays of int64)."""
    own = mixed((rep + (seed * 8 + stream) * REP_FACTOR) & MASK)
    return mixed(((own ^ (place & MASK)) + (place >> 32) * HIGH_FACTOR) & MASK)


def _mixed_sql(x: str) -> str:
    for shift, factor in ((16, FACTORS[0]), (15, FACTORS[1])):
        x = f"list_transform([{x}], lambda v: (xor(v, v >> {shift}) * {factor}) & {MASK})[1]"
    return f"list_transform([{x}], lambda v: xor(v, v >> 16))[1]"


def hash_sql(seed: int, stream: int, rep: str, place: str) -> str:
    """The same hash as DuckDB SQL of two BIGINT expressions."""
    own = _mixed_sql(f"(CAST({rep} AS BIGINT) + {(seed * 8 + stream) * REP_FACTOR}) & {MASK}")
    return _mixed_sql(f"(xor({own}, CAST({place} AS BIGINT) & {MASK}) + (CAST({place} AS BIGINT) >> 32) * {HIGH_FACTOR}) & {MASK}")


def draws_sql(rows: str, n_boot: int, seed: int) -> str:
    """Queries that give ``draws(rep, idx)`` for a table with ``idx`` and ``total``."""
    size = f"least({BUCKET_ROWS}, total - bucket * {BUCKET_ROWS})"
    return f"""place AS (SELECT CAST(rep AS BIGINT) AS rep, idx, total FROM (SELECT idx, total FROM {rows}), generate_series(1, {n_boot}) g(rep)),
bucketed AS (SELECT rep, total, CAST(floor(({hash_sql(seed, BUCKET_HIGH, 'rep', 'idx')} * 2097152 + ({hash_sql(seed, BUCKET_LOW, 'rep', 'idx')} >> 11)) / 9007199254740992.0::DOUBLE * total) AS BIGINT) // {BUCKET_ROWS} AS bucket FROM place),
per_bucket AS (SELECT rep, bucket, any_value(total) AS total, count(*) AS n FROM bucketed GROUP BY 1, 2),
each_draw AS (SELECT rep, bucket, total, unnest(range(n)) AS k FROM per_bucket),
draws AS (SELECT rep, bucket * {BUCKET_ROWS} + {hash_sql(seed, ROW, 'rep', f'(bucket << {PLACE_BITS}) + k')} % {size} AS idx FROM each_draw)"""


def poisson_edges() -> list[float]:
    """Cumulative Poisson(1) probabilities; the tail above 12 is below 1e-10."""
    edges, total, term = [], 0.0, 2.718281828459045**-1
    for k in range(12):
        total += term
        edges.append(total)
        term /= k + 1
    return edges


GROUP_DIGITS = 2


def numbered_rows(wide: DataFrame) -> DataFrame:
    """Place of each row over all series (``idx``) and their number (``total``).

    Series come in order of a hash group, then of their id: the rows before a
    group are a sum over at most 256 numbers, those before a series in its group
    a running sum inside the group."""
    rows = with_row_index(wide)
    group = F.substring(F.md5(F.col("series_id").cast("string")), 1, GROUP_DIGITS)
    sizes = rows.groupBy("series_id").agg(F.count(F.lit(1)).alias("_size")).withColumn("_group", group)
    groups = sizes.groupBy("_group").agg(F.sum("_size").alias("n")).agg(F.collect_list(F.struct("_group", "n")).alias("_all"))
    added = lambda a, b: a + b["n"]
    zero = F.lit(0).cast("long")
    inside = Window.partitionBy("_group").orderBy("series_id").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.join(F.broadcast(groups)).select(
        "series_id",
        (F.aggregate(F.filter("_all", lambda g: g["_group"] < F.col("_group")), zero, added) + F.coalesce(F.sum("_size").over(inside), zero)).alias("_start"),
        F.aggregate("_all", zero, added).alias("total"),
    )
    return rows.join(sizes, "series_id").withColumn("idx", F.col("_start") + F.col("row_idx")).drop("_start", "row_idx", "n_rows")


#: The order of ``numbered_rows`` in SQL.
ORDER_SQL = f"substr(md5(CAST(series_id AS VARCHAR)), 1, {GROUP_DIGITS}), series_id, date"


def bucket_draws(df: DataFrame, total: int, n_boot: int, seed: int) -> DataFrame:
    """``_b`` and ``_draws``: for each bucket the draws of every replicate in it."""
    chunks = max(1, -(-total // CHUNK_DRAWS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for task in batch.column("id").to_pylist():
                rep, chunk = task // chunks + 1, task % chunks
                place = np.arange(chunk * CHUNK_DRAWS, min(total, (chunk + 1) * CHUNK_DRAWS))
                high, low = (hash_of(seed, stream, np.int64(rep), place) for stream in (BUCKET_HIGH, BUCKET_LOW))
                drawn = ((high * 2097152 + (low >> 11)) / 9007199254740992.0 * total).astype(np.int64) // BUCKET_ROWS
                at, n = np.unique(drawn, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(len(at), rep)), pa.array(n)], ["_b", "rep", "n"])

    counts = df.sparkSession.range(n_boot * chunks).mapInArrow(count, "_b long, rep long, n long")
    counts = counts.groupBy("_b", "rep").agg(F.sum("n").alias("n"))
    return counts.groupBy("_b").agg(F.collect_list(F.struct("rep", "n")).alias("_draws"))


def bucketed_rows(wide: DataFrame, columns: Sequence[str], n_boot: int, seed: int, method: str) -> DataFrame:
    """One row for each bucket: ``_b``, ``_rows`` (place and columns) and, unless
    Poisson, ``_draws``."""
    if method not in ("draws", "poisson"):
        raise ValueError("method must be 'draws' or 'poisson'")
    numbered = materialize(numbered_rows(wide).select("idx", *columns), "numbered-rows")
    bucket = F.call_function("div", F.col("idx"), F.lit(BUCKET_ROWS).cast("long"))
    rows = numbered.groupBy(bucket.alias("_b")).agg(F.collect_list(F.struct((F.col("idx") % BUCKET_ROWS).alias("place"), *columns)).alias("_rows"))
    if method == "draws":
        return rows.join(bucket_draws(wide, numbered.count(), n_boot, seed), "_b")
    return rows


def weight_matrices(bucket: int, size: int, draws: tuple[np.ndarray, np.ndarray] | None, n_boot: int, seed: int) -> Iterator[tuple[int, np.ndarray]]:
    """The first replicate and the weights (replicates x places of the bucket) of
    some replicates at a time."""
    edges = np.array(poisson_edges())
    counts = np.zeros(n_boot, np.int64)
    if draws is not None:
        counts[draws[0] - 1] = draws[1]
    for first in range(0, n_boot, REPS_AT_ONCE):
        reps = np.arange(first, min(first + REPS_AT_ONCE, n_boot))
        if draws is None:
            u = hash_of(seed, POISSON, (reps + 1)[:, None], bucket * BUCKET_ROWS + np.arange(size)[None, :]) / 4294967296.0
            yield first, np.searchsorted(edges, u, "right")
            continue
        n = counts[reps]
        place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        row = hash_of(seed, ROW, np.repeat(reps + 1, n), (bucket << PLACE_BITS) + place) % size
        yield first, np.bincount(np.repeat(reps - first, n) * size + row, minlength=len(reps) * size).reshape(len(reps), size)


def buckets_of(batch: pa.RecordBatch, columns: Sequence[str]) -> Iterator[tuple[int, list[np.ndarray], tuple[np.ndarray, np.ndarray] | None]]:
    """Number, columns in order of place, and draws of each bucket of a batch."""
    drawn = "_draws" in batch.schema.names
    for r in range(batch.num_rows):
        rows = batch.column("_rows")[r].values
        order = np.argsort(rows.field("place").to_numpy(zero_copy_only=False))
        values = [rows.field(c).to_numpy(zero_copy_only=False)[order] for c in columns]
        d = batch.column("_draws")[r].values if drawn else None
        yield batch.column("_b")[r].as_py(), values, (d.field("rep").to_numpy(), d.field("n").to_numpy()) if drawn else None


@dataclass(frozen=True)
class SumMetric:
    """A metric of weighted sums: ``terms`` of a row, and its ``value`` from the
    sums of weights and of weighted terms."""

    terms: Callable[[Column, Column], list[Column]]
    value: Callable[[Column, list[Column]], Column]


def weighted_sums(wide: DataFrame, terms: dict[str, Column], n_boot: int, seed: int, method: str) -> DataFrame:
    """``rep``, ``weight`` and the weighted sum of each term per replicate. A task
    adds its buckets up first, so it shuffles one row for each replicate."""
    names = list(terms)
    values = wide.select("series_id", "date", *[t.cast("double").alias(c) for c, t in terms.items()])
    rows = bucketed_rows(values, names, n_boot, seed, method)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_boot, len(names) + 1))
        for batch in batches:
            for bucket, columns, draws in buckets_of(batch, names):
                table = np.column_stack([np.ones(len(columns[0])), *columns])
                for first, weights in weight_matrices(bucket, len(table), draws, n_boot, seed):
                    total[first : first + len(weights)] += weights @ table
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(1, n_boot + 1)), *map(pa.array, total.T)], ["rep", "weight", *names])

    sums = rows.mapInArrow(add, ", ".join(["rep long", "weight double", *[f"{c} double" for c in names]]))
    return sums.groupBy("rep").agg(*[F.sum(c).alias(c) for c in ("weight", *names)])


def replicate_aucs(wide: DataFrame, label: str, scores: Sequence[str], n_boot: int, seed: int, method: str) -> DataFrame:
    """``side`` (number of the score column), ``rep`` (0: all rows once) and ``auc``.

    A bucket of rows sends each of its distinct scores once, with the weights of
    all replicates. These are dealt by score; a task meets them in order and keeps
    running sums over replicates alone. Buckets of scores are joined by the
    weights below them."""
    typed = wide.select("series_id", "date", F.col(label).cast("double").alias("_y"), *[F.col(c).cast("double").alias(c) for c in scores])
    rows = bucketed_rows(typed, ["_y", *scores], n_boot, seed, method)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, (y, *columns), draws in buckets_of(batch, ["_y", *scores]):
                weights = np.empty((n_boot + 1, len(y)), np.int32)
                weights[0] = 1
                for first, part in weight_matrices(bucket, len(y), draws, n_boot, seed):
                    weights[first + 1 : first + 1 + len(part)] = part
                for side, s in enumerate(columns):
                    order = np.lexsort((y, s))
                    new = np.flatnonzero(np.concatenate([[True], (np.diff(s[order]) != 0) | (np.diff(y[order]) != 0)]))
                    sums = np.add.reduceat(weights[:, order], new, axis=1).astype(np.uint16)
                    for k in range(0, len(new), 512):
                        at = order[new[k : k + 512]]
                        packed = [np.ascontiguousarray(w).tobytes() for w in sums[:, k : k + 512].T]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), side)), pa.array(s[at]), pa.array(y[at] == 1), pa.array(packed, pa.binary())], ["side", "score", "positive", "weights"])

    sent = materialize(rows.mapInArrow(weigh, "side long, score double, positive boolean, weights binary"), "score-weights")
    dealt = with_bucket(sent, "score").repartition("side", BUCKET).sortWithinPartitions("side", BUCKET, "score")

    def area(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, score = None, None
        # Weights of positives and negatives so far; twice the area; of the score at hand.
        p = q = u = tied_p = tied_q = np.zeros(n_boot + 1, np.int64)

        def done() -> pa.RecordBatch:
            n = n_boot + 1
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, now[0])), pa.array(np.full(n, now[1])), pa.array(np.arange(n)), *map(pa.array, (p, q, u))], ["side", "part", "rep", "p", "q", "u"])

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("side", BUCKET, "score", "positive")), batch.column("weights"), strict=True)
            for side, bucket, s, positive, packed in keys:
                if now is not None and (now != (side, bucket) or s != score):
                    u = u + tied_p * (2 * q + tied_q)
                    p, q = p + tied_p, q + tied_q
                    tied_p = tied_q = np.zeros(n_boot + 1, np.int64)
                    if now != (side, bucket):
                        yield done()
                        p = q = u = tied_p
                now, score = (side, bucket), s
                w = np.frombuffer(packed.as_py(), np.uint16).astype(np.int64)
                if positive:
                    tied_p = tied_p + w
                else:
                    tied_q = tied_q + w
        if now is not None:
            u = u + tied_p * (2 * q + tied_q)
            p, q = p + tied_p, q + tied_q
            yield done()

    parts = dealt.select("side", F.col(BUCKET).cast("long").alias(BUCKET), "score", "positive", "weights")
    parts = parts.mapInArrow(area, "side long, part long, rep long, p long, q long, u long")
    below = Window.partitionBy("side", "rep").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("below", F.coalesce(F.sum("q").over(below), F.lit(0)))
    areas = parts.groupBy("side", "rep").agg(F.sum(F.col("u") + 2 * F.col("p") * F.col("below")).alias("u"), F.sum("p").alias("p"), F.sum("q").alias("q"))
    return areas.select("side", "rep", F.try_divide(F.col("u").cast("double"), 2.0 * F.col("p") * F.col("q")).alias("auc"))
