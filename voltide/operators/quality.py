"""Data quality and exploration of bar tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltide.functions.scalars import ratio
from voltide.plans.ranking import column_quantiles
from voltide.session import materialize

PATTERNS = ("pat_doji", "pat_hammer", "pat_engulf_bull", "pat_engulf_bear")


def weekdays_until(day: Column) -> Column:
    """Number of Monday-Friday days from Monday 1969-12-29 up to ``day``."""
    k = F.unix_date(day) + F.lit(3)
    return F.floor(k / F.lit(7.0)) * F.lit(5) + F.least(F.pmod(k, F.lit(7)) + F.lit(1), F.lit(5))


def weekdays_between(first: Column, last: Column) -> Column:
    return weekdays_until(last) - weekdays_until(F.date_sub(first, 1))


def ohlc_faults() -> dict[str, Column]:
    top, bottom = F.greatest("open", "close"), F.least("open", "close")
    return {
        "n_high_lt_low": F.count_if(F.col("high") < F.col("low")),
        "n_high_lt_open_close": F.count_if(F.col("high") < top),
        "n_low_gt_open_close": F.count_if(F.col("low") > bottom),
    }


def volume_faults() -> dict[str, Column]:
    return {
        "n_negative_volume": F.count_if(F.col("volume") < 0),
        "n_null_volume": F.count_if(F.col("volume").isNull()),
    }


def basic_qa(df: DataFrame) -> DataFrame:
    """Rows and date range per series."""
    return df.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("date_min"), F.max("date").alias("date_max")
    )


def duplicate_dates(df: DataFrame) -> DataFrame:
    return df.groupBy("series_id").agg(
        (F.count(F.lit(1)) - F.count_distinct("date")).alias("n_duplicates_date")
    )


def business_day_gaps(df: DataFrame) -> DataFrame:
    """Expected, present and missing business days. The calendar is counted
    by arithmetic, so no date list is built; days are made distinct first, so
    every count is a plain sum."""
    day = F.col("date").cast("date")
    days = df.select("series_id", day.alias("_day")).distinct()
    spans = days.groupBy("series_id").agg(
        F.min("_day").alias("_first"),
        F.max("_day").alias("_last"),
        F.count("_day").alias("n_business_days_present"),
        F.count_if(F.weekday("_day") < 5).alias("_hit"),
    )
    expected = weekdays_between(F.col("_first"), F.col("_last"))
    return spans.select(
        "series_id",
        expected.alias("n_business_days_expected"),
        "n_business_days_present",
        (expected - F.col("_hit")).alias("n_business_days_missing"),
        F.coalesce(ratio((expected - F.col("_hit")) * 100, expected), F.lit(0.0)).alias("pct_business_days_missing"),
    )


def missing_business_days(df: DataFrame) -> DataFrame:
    """The missing days themselves."""
    day = F.col("date").cast("date")
    spans = df.groupBy("series_id").agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    calendar = spans.select("series_id", F.explode(F.sequence("_a", "_b")).alias("date"))
    present = df.select("series_id", day.alias("date"))
    return calendar.where(F.weekday("date") < 5).join(present, ["series_id", "date"], "left_anti")


def ohlc_rules(df: DataFrame) -> DataFrame:
    return df.groupBy("series_id").agg(*[c.alias(n) for n, c in ohlc_faults().items()])


def volume_rules(df: DataFrame) -> DataFrame:
    return df.groupBy("series_id").agg(*[c.alias(n) for n, c in volume_faults().items()])


REPORT_ORDER = (
    "n_business_days_missing",
    "n_duplicates_date",
    "n_high_lt_low",
    "n_high_lt_open_close",
    "n_low_gt_open_close",
)


def qa_report(df: DataFrame) -> DataFrame:
    """All checks, one row per series, worst first. Series without a readable
    row stay in the report with an ``error`` text when ``df`` has one."""
    faults = {**ohlc_faults(), **volume_faults()}
    # One row per day first: distinct days are then counted without expanding rows.
    days = df.groupBy("series_id", F.col("date").cast("date").alias("_day")).agg(F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in faults.items()])
    known = F.col("_day").isNotNull()
    out = days.groupBy("series_id").agg(
        F.sum("_rows").alias("n_rows"),
        F.min("_day").alias("date_min"),
        F.max("_day").alias("date_max"),
        F.coalesce(F.sum(F.when(known, F.col("_rows") - 1)), F.lit(0)).alias("n_duplicates_date"),
        F.count_if(known & (F.weekday("_day") < 5)).alias("_hit"),
        *[F.sum(n).alias(n) for n in faults],
    )
    expected = weekdays_between(F.col("date_min"), F.col("date_max"))
    out = out.withColumns(
        {
            "n_business_days_missing": expected - F.col("_hit"),
            "pct_business_days_missing": F.coalesce(ratio((expected - F.col("_hit")) * 100, expected), F.lit(0.0)),
            "error": F.when(F.col("date_min").isNull(), F.lit("no readable date")),
        }
    ).drop("_hit")
    return out.orderBy(*[F.col(c).desc() for c in REPORT_ORDER], "series_id")


def faulty_series(df: DataFrame) -> DataFrame:
    """Series with any OHLC fault, out of all series."""
    rules = ohlc_rules(df)
    bad = (F.col("n_high_lt_low") > 0) | (F.col("n_high_lt_open_close") > 0) | (F.col("n_low_gt_open_close") > 0)
    return rules.agg(F.count(F.lit(1)).alias("n_series"), F.count_if(bad).alias("n_faulty"))


def liquidity_ranking(df: DataFrame, min_rows: int = 1500, top: int = 15) -> DataFrame:
    """Score = rows/1000 - 0.2 * % missing days + 0.1 * ln(1 + mean volume)."""
    gaps = business_day_gaps(df).select("series_id", "pct_business_days_missing")
    size = df.groupBy("series_id").agg(F.count(F.lit(1)).alias("n_rows"), F.avg("volume").alias("mean_volume"))
    score = (
        F.col("n_rows") / F.lit(1000.0)
        - F.lit(0.2) * F.col("pct_business_days_missing")
        + F.lit(0.1) * F.log1p("mean_volume")
    )
    return (
        size.where(F.col("n_rows") >= min_rows)
        .join(gaps, "series_id")
        .withColumn("score", score)
        .orderBy(F.col("score").desc(), "series_id")
        .limit(top)
    )


STATISTICS = ("count", "mean", "std", "min", "p25", "p50", "p75", "max")


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, extremes and exact quartiles of each column."""
    columns = list(columns)
    # Written, as the quartiles read it several times; only values near a quartile
    # are then counted and ordered.
    table = materialize(df.select(*[F.col(c).cast("double").alias(c) for c in columns]), "described")
    kinds = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    one = table.agg(*[F.struct(F.lit(c).alias("column"), *[f(c).alias(n) for n, f in kinds.items()]).alias(f"_{i}") for i, c in enumerate(columns)])
    moments = one.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(columns))]))).where(F.col("count") > 0)
    quartiles = column_quantiles(table, columns, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return moments.join(quartiles, "column").select("column", *STATISTICS)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return row.unpivot([], list(columns), "column", "n_null")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum, empty ones too; the last
    bin is closed. Without a known value there are no bins."""
    value = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    limits = value.agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    width = F.when(F.col("_hi") > F.col("_lo"), (F.col("_hi") - F.col("_lo")) / F.lit(float(bins)))
    place = F.coalesce(F.floor((F.col("v") - F.col("_lo")) / width), F.lit(0))
    counts = (
        value.join(F.broadcast(limits))
        .select(F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    every = limits.where(F.col("_lo").isNotNull()).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return every.join(F.broadcast(counts), "bin", "left").select(
        "bin",
        (F.col("_lo") + F.col("bin") * step).alias("bin_from"),
        (F.col("_lo") + (F.col("bin") + 1) * step).alias("bin_to"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


def pattern_frequency(df: DataFrame, by_series: bool = False, patterns: Sequence[str] = PATTERNS) -> DataFrame:
    """Count and percentage of each 0/1 flag, pooled or per series."""
    keys = ["series_id"] if by_series else []
    long = df.select(*keys, *patterns).unpivot(keys, list(patterns), "pattern", "hit")
    out = long.groupBy(*keys, "pattern").agg(
        F.sum("hit").alias("n"), (F.avg("hit") * 100).alias("pct")
    )
    return out.orderBy(F.col("n").desc(), *keys, "pattern")


def series_summary(df: DataFrame, patterns: Sequence[str] = PATTERNS) -> DataFrame:
    return (
        df.groupBy("series_id")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("date").alias("date_min"),
            F.max("date").alias("date_max"),
            *[F.sum(p).alias(p) for p in patterns],
        )
        .orderBy(F.col("n_rows").desc(), "series_id")
    )


def class_balance(df: DataFrame, keys: Sequence[str] = ("split",), label: str = "target_class") -> DataFrame:
    known = df.where(F.col(label).isNotNull())
    return known.groupBy(*keys).agg(
        F.count_if(F.col(label) == 0).alias("n_0"),
        F.count_if(F.col(label) == 1).alias("n_1"),
        F.avg(F.col(label).cast("double")).alias("p_1"),
    )


def flagged_events(df: DataFrame, pattern: str) -> DataFrame:
    return df.where(F.col(pattern) == 1).select("series_id", "date", "close")


def row_slice(df: DataFrame, start: int, stop: int) -> DataFrame:
    """Rows ``start`` to ``stop - 1`` by position (needs ``row_idx``)."""
    return df.where((F.col("row_idx") >= start) & (F.col("row_idx") < stop))
