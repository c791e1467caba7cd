"""Ranks, running totals and exact quantiles without one task per group.

Values are put in order-preserving buckets whose borders are approximate
quantiles of all rows together, from sketches that are merged in two levels; there
are as many buckets as hold ``BUCKET_ROWS`` rows each. A bucket therefore holds a
bounded number of rows whatever the group sizes are. Totals per (group, bucket)
form a small table; its running sums are added to running sums inside each bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows that a bucket is to hold, and most buckets (their borders are sent to all tasks).
BUCKET_ROWS, MAX_BUCKETS = 4096, 1 << 13
#: Size of a sketch (ranks are off by about 2 / size) and sketches merged at once.
SKETCH_SIZE, SKETCH_GROUPS = 8192, 64
BUCKET = "_bucket"


def bucket_borders(df: DataFrame, value: str, rows: int | None = None) -> list[float]:
    """The inner borders of the buckets. Tasks sketch their rows, groups of tasks
    and then the groups are merged; one row is read. (Sketches are random: borders
    must be read once, not planned into two branches of a query.)"""
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))
    part = df.select(F.col(value).cast("double").alias("_v"), group.alias("_g")).where(F.col("_v").isNotNull())
    sketches = part.groupBy("_g").agg(F.kll_sketch_agg_double("_v", SKETCH_SIZE).alias("_s"))
    one = sketches.agg(F.kll_merge_agg_double("_s", SKETCH_SIZE).alias("_s"), F.sum(F.kll_sketch_get_n_double("_s")).alias("_n"))
    sketch, n = one.first()
    buckets = min(-(-(n or 0) // (rows or BUCKET_ROWS)), MAX_BUCKETS)
    if buckets < 2:
        return []
    shares = F.array(*[F.lit(k / buckets) for k in range(1, buckets)])
    kept = df.sparkSession.createDataFrame([(bytes(sketch),)], "_s binary")
    return sorted(set(kept.select(F.kll_sketch_get_quantile_double("_s", shares)).first()[0]))


def bucket_of(value: Column, borders: Column, buckets: int) -> Column:
    """Number of borders below ``value``: a binary search over the array."""
    steps = [1 << s for s in reversed(range(max(buckets - 1, 0).bit_length()))]
    if not steps:
        return F.lit(0)
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda low, step: F.when(value > F.get(borders, low + step - F.lit(1)), low + step).otherwise(low),
    )


def with_bucket(df: DataFrame, value: str, rows: int | None = None) -> DataFrame:
    """Add the bucket of ``value``; the one-row border table is broadcast."""
    borders = bucket_borders(df, value, rows)
    if not borders:
        return df.withColumn(BUCKET, F.lit(0))
    table = df.sparkSession.createDataFrame([(borders,)], "_borders array<double>")
    found = bucket_of(F.col(value).cast("double"), F.col("_borders"), len(borders) + 1)
    return df.join(F.broadcast(table)).withColumn(BUCKET, found).drop("_borders")


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    sums: Sequence[str],
    descending: bool = False,
) -> DataFrame:
    """For a table with one row per (group, value): ``cum_<s>`` = total of
    ``s`` up to and including the row, ``all_<s>`` = total of the group."""
    groups, order = list(groups), (lambda c: F.col(c).desc() if descending else F.col(c).asc())
    spread = with_bucket(df, value)
    totals = spread.groupBy(*groups, BUCKET).agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
    whole = Window.partitionBy(*groups)
    before = whole.orderBy(order(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *groups,
        BUCKET,
        *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_b_{s}") for s in sums],
        *[F.sum(f"_t_{s}").over(whole).alias(f"all_{s}") for s in sums],
    )
    inside = Window.partitionBy(*groups, BUCKET).orderBy(order(value)).rowsBetween(Window.unboundedPreceding, 0)
    joined = spread.join(totals, [*groups, BUCKET])
    return joined.withColumns({f"cum_{s}": F.col(f"_b_{s}") + F.sum(s).over(inside) for s in sums}).drop(
        BUCKET, *[f"_b_{s}" for s in sums]
    )


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, quantiles: dict[str, float], weight: str | None = None
) -> DataFrame:
    """Linearly interpolated quantiles (``numpy`` default) per group.

    Equal values are counted first; then the two order statistics around each
    quantile are picked out of the running counts.
    """
    groups = list(groups)
    helper = groups or ["_all"]
    rows = df if groups else df.withColumn("_all", F.lit(0))
    rows = rows.where(F.col(value).isNotNull())
    counted = rows.groupBy(*helper, value).agg(
        (F.count(F.lit(1)) if weight is None else F.sum(weight)).cast("long").alias("_n")
    )
    running = running_totals(counted, helper, value, ["_n"])
    picks = []
    for name, q in quantiles.items():
        place = (F.col("all__n") - F.lit(1)) * F.lit(float(q))
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            covers = (F.col("cum__n") > rank) & (F.col("cum__n") - F.col("_n") <= rank)
            picks.append(F.max(F.when(covers, F.col(value).cast("double"))).alias(f"_{name}_{side}"))
        picks.append(F.max(place - F.floor(place)).alias(f"_{name}_part"))
    found = running.groupBy(*helper).agg(*picks)
    return found.select(
        *groups,
        *[
            (F.col(f"_{n}_lo") + (F.col(f"_{n}_hi") - F.col(f"_{n}_lo")) * F.col(f"_{n}_part")).alias(n)
            for n in quantiles
        ],
    )


SLACK = 0.0005


def column_quantiles(df: DataFrame, columns: Sequence[str], quantiles: dict[str, float]) -> DataFrame:
    """Exact quantiles of many columns: ``(column, <name> ...)``; null for a
    column without a known value.

    A sketch of all columns (one row, read by the driver) brackets each
    quantile; only values inside the brackets are counted and ordered, so
    almost nothing of a large table is shuffled. A bracket reaches ``SLACK`` of
    the known values of its column, and two values more, to either side: beyond
    the sketch's error and beyond both order statistics. A wanted rank outside
    its bracket raises.
    """
    columns, names = list(columns), list(quantiles)
    typed = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    known = typed.agg(*[F.count(c).alias(f"_n{i}") for i, c in enumerate(columns)]).first()

    def shares(i: int) -> list[float]:
        slack = SLACK + 2.0 / max(known[i], 1)
        return [s for q in quantiles.values() for s in (max(q - slack, 0.0), min(q + slack, 1.0))]

    sketch = typed.agg(*[F.percentile_approx(c, shares(i), 10_000).alias(f"_s{i}") for i, c in enumerate(columns)]).first()

    def bracket(i: int, k: int) -> tuple[float, float]:
        cuts = sketch[f"_s{i}"] or [0.0] * 2 * len(names)
        return cuts[2 * k], cuts[2 * k + 1]

    limits = [(c, *[x for k in range(len(names)) for x in bracket(i, k)]) for i, c in enumerate(columns)]
    schema = ", ".join(["column string", *[f"_lo{k} double, _hi{k} double" for k in range(len(names))]])
    table = F.broadcast(df.sparkSession.createDataFrame(limits, schema))
    long = typed.unpivot([], columns, "column", "v").where(F.col("v").isNotNull()).join(table, "column")
    inside: Column = F.lit(False)
    for k in range(len(names)):
        inside = inside | F.col("v").between(F.col(f"_lo{k}"), F.col(f"_hi{k}"))
    counted = long.where(inside).groupBy("column", "v").agg(F.count(F.lit(1)).alias("_n"))
    running = running_totals(counted, ["column"], "v", ["_n"])
    # Rows below a kept value = kept rows below it + dropped rows below its
    # bracket.
    totals = long.groupBy("column").agg(
        F.count(F.lit(1)).alias("_total"),
        *[F.count_if((F.col("v") < F.col(f"_lo{k}")) & ~inside).alias(f"_dropped{k}") for k in range(len(names))],
    )
    joined = running.join(F.broadcast(totals), "column")
    picks = []
    for k, (name, q) in enumerate(quantiles.items()):
        place = (F.col("_total") - F.lit(1)) * F.lit(float(q))
        for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            local = rank - F.col(f"_dropped{k}")
            covers = (F.col("cum__n") > local) & (F.col("cum__n") - F.col("_n") <= local)
            picks.append(F.max(F.when(covers, F.col("v"))).alias(f"_{name}_{side}"))
        picks.append(F.max(place - F.floor(place)).alias(f"_{name}_part"))
    found = F.broadcast(joined.groupBy("column").agg(*picks))
    every = df.sparkSession.createDataFrame([(c, known[i] > 0) for i, c in enumerate(columns)], "column string, _known boolean")

    def value(n: str) -> Column:
        lo, hi = F.col(f"_{n}_lo"), F.col(f"_{n}_hi")
        missed = F.raise_error(F.concat(F.lit("rank outside its bracket in column "), F.col("column"))).cast("double")
        return F.when(~F.col("_known"), F.lit(None)).when(lo.isNull() | hi.isNull(), missed).otherwise(lo + (hi - lo) * F.col(f"_{n}_part"))

    return every.join(found, "column", "left").select("column", *[value(n).alias(n) for n in names])
