"""Bars from trade-like tables: one deterministic aggregation per bar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def to_bars(
    ticks: DataFrame,
    series: Column,
    date: Column,
    price: Column,
    volume: Column,
    tie: Sequence[str],
) -> DataFrame:
    """Open/close are the first/last price in ``tie`` order. Partial
    aggregation runs before the shuffle, so a hot series costs little."""
    order = F.struct(*[F.col(c) for c in tie])
    ticks = ticks.select(
        series.alias("series_id"), date.alias("date"), price.alias("_p"), volume.alias("_v"), order.alias("_o")
    )
    return ticks.groupBy("series_id", "date").agg(
        F.min_by("_p", "_o").alias("open"),
        F.max("_p").alias("high"),
        F.min("_p").alias("low"),
        F.max_by("_p", "_o").alias("close"),
        F.sum("_v").cast("double").alias("volume"),
    )


LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def line_bars(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    """Daily bars of unit prices in ``lineitem`` per value of ``key``."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    # Numbers sort faster than their strings: the key becomes a name after the sums.
    bars = to_bars(
        lines,
        F.col(key),
        F.col("l_shipdate").cast("date"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")),
        F.col("l_quantity"),
        LINE_ORDER,
    )
    return bars.withColumn("series_id", F.col("series_id").cast("string"))


def flag_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_bars(spark, sf_dir, "l_returnflag")


def supplier_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_bars(spark, sf_dir, "l_suppkey")


def event_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars of ``events.value`` per event type."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return to_bars(
        events,
        F.col("event_type"),
        F.date_trunc("hour", F.col("ts")),
        F.col("value"),
        F.lit(1.0),
        ("ts", "event_id"),
    )
