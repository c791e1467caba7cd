"""How a panel is cut so that one long series never sits in one task.

``with_row_index`` numbers the rows of every series in date order, and
``blocked`` cuts a numbered series into blocks of ``BLOCK_ROWS`` rows and
copies to each block the few rows before and after it that a window frame
needs (the halo). Windows then run inside ``(series, block)``: same values as
a window over the whole series, but the largest group has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltide.session import materialize
from voltide.settings import BLOCK_ROWS

DAY_SECONDS = 86_400
BLOCK = "_block"
SPAN = "_span"
#: Parts into which an overfull span is cut at a time.
CUTS = 64


def with_span(df: DataFrame, keys: Sequence[str], date: str, grain_seconds: int | None = None) -> DataFrame:
    """Add ``SPAN``: numbers that rise with the date and hold at most about
    ``BLOCK_ROWS`` rows of a series each.

    With one bar per series and day (dates, or a grain given in seconds) a span is
    ``BLOCK_ROWS`` grains of the calendar. Else each series gets spans of its own
    width, for half as many rows on average; those that hold too many all the same,
    by a count, are cut until they do not (or are a second wide). A series of few rows, however near
    each other, thus has no say in the spans of another."""
    keys = list(keys)
    if isinstance(df.schema[date].dataType, T.DateType):
        return df.withColumn(SPAN, F.floor(F.unix_date(F.col(date)) * F.lit(DAY_SECONDS) / F.lit(float((grain_seconds or DAY_SECONDS) * BLOCK_ROWS))).cast("long"))
    at = F.unix_seconds(F.col(date).cast("timestamp"))
    if grain_seconds is not None:
        return df.withColumn(SPAN, F.floor(at / F.lit(float(grain_seconds * BLOCK_ROWS))).cast("long"))
    half = F.lit(float(BLOCK_ROWS // 2))
    series = df.groupBy(*keys).agg(F.min(at).alias("_first"), F.max(at).alias("_end"), F.count(F.lit(1)).alias("_rows"))
    width = F.ceil((F.col("_end") - F.col("_first") + 1) / F.ceil(F.col("_rows") / half)).cast("long")
    series = series.select(*keys, "_first", F.greatest(width, F.lit(1).cast("long")).alias("_width"))
    series = materialize(series, "series-spans")
    rows = df.join(series, keys).withColumn(SPAN, F.call_function("div", at - F.col("_first"), F.col("_width")))
    rows = rows.withColumn("_first", F.col("_first") + F.col(SPAN) * F.col("_width"))
    while True:
        full = rows.where(F.col("_width") > 1).groupBy(*keys, SPAN).agg(F.count(F.lit(1)).alias("_n"))
        full = materialize(full.where(F.col("_n") > BLOCK_ROWS).select(*keys, SPAN, F.lit(True).alias("_full")), "full-spans")
        if full.isEmpty():
            break
        rows = rows.join(full, [*keys, SPAN], "left")
        width = F.when(F.col("_full"), F.ceil(F.col("_width") / CUTS).cast("long")).otherwise(F.col("_width"))
        part = F.when(F.col("_full"), F.call_function("div", at - F.col("_first"), F.col("_finer"))).otherwise(F.lit(0).cast("long"))
        rows = rows.withColumn("_finer", width).withColumn("_part", part)
        rows = rows.withColumns(
            {"_first": F.col("_first") + F.col("_part") * F.col("_finer"), "_width": F.col("_finer"), SPAN: F.col(SPAN) * CUTS + F.col("_part")}
        ).drop("_full", "_finer", "_part")
    return rows.drop("_first", "_width")


def with_row_index(
    df: DataFrame,
    keys: Sequence[str] = ("series_id",),
    date: str = "date",
    tie: Sequence[str] = (),
    grain_seconds: int | None = None,
    forward_fill: Iterable[str] = (),
) -> DataFrame:
    """Add ``row_idx`` (0-based place in the series) and ``n_rows`` (its length).

    Rows are numbered inside calendar buckets and shifted by the number of
    rows in earlier buckets, taken from a small aggregated table (see
    ``with_span``). For columns in ``forward_fill`` a ``<name>_ffill`` column carries the last known value
    across any distance.
    """
    keys, fills = list(keys), list(forward_fill)
    spans = with_span(df, keys, date, grain_seconds)
    last_known = [
        F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(date))).alias(f"_last_{c}")
        for c in fills
    ]
    counts = spans.groupBy(*keys, SPAN).agg(F.count(F.lit(1)).alias("_n"), *last_known)
    ordered = Window.partitionBy(*keys).orderBy(SPAN)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *keys,
        SPAN,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("n_rows"),
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in fills],
    )
    inside = Window.partitionBy(*keys, SPAN).orderBy(date, *tie)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    return (
        spans.join(counts, [*keys, SPAN])
        .withColumns(
            {
                "row_idx": F.row_number().over(inside) + F.col("_before") - 1,
                **{
                    f"{c}_ffill": F.coalesce(F.last(c, ignorenulls=True).over(so_far), F.col(f"_carry_{c}"))
                    for c in fills
                },
            }
        )
        .drop(SPAN, "_before", *[f"_carry_{c}" for c in fills])
    )


def blocked(df: DataFrame, back: int = 0, ahead: int = 0, rows: int = BLOCK_ROWS) -> DataFrame:
    """Assign rows to blocks, copying ``back`` rows before and ``ahead`` rows
    after each block into it."""
    size = F.lit(rows).cast("long")
    first = F.call_function("div", F.greatest(F.col("row_idx") - F.lit(ahead), F.lit(0)).cast("long"), size)
    last = F.call_function(
        "div", F.least(F.col("row_idx") + F.lit(back), F.col("n_rows") - F.lit(1)).cast("long"), size
    )
    return df.withColumn(BLOCK, F.explode(F.sequence(first, last)))


def block_window(keys: Sequence[str] = ("series_id",)) -> WindowSpec:
    return Window.partitionBy(*keys, BLOCK).orderBy("row_idx")


def without_halo(df: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """Keep each row only in the block that owns it."""
    owner = F.call_function("div", F.col("row_idx").cast("long"), F.lit(rows).cast("long"))
    return df.where(owner == F.col(BLOCK)).drop(BLOCK)


def trailing(window: WindowSpec, n: int) -> WindowSpec:
    return window.rowsBetween(-(n - 1), 0)


def full_frame(value: Column, aggregate: Column, frame: WindowSpec, n: int) -> Column:
    """Aggregate over a frame, null unless the frame holds ``n`` known values."""
    return F.when(F.count(value).over(frame) == n, aggregate.over(frame))


def rolling(value: Column | str, how, window: WindowSpec, n: int) -> Column:
    """Trailing ``n``-row aggregate; ``how`` is e.g. ``F.avg``."""
    value = F.col(value) if isinstance(value, str) else value
    return full_frame(value, how(value), trailing(window, n), n)
