"""Reading raw bar files: typed, cleaned, ordered by (series, date)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltide.functions.scalars import hash_draw
from voltide.settings import SEED, START_DATE

PRICES = ("open", "high", "low", "close")
NUMBERS = (*PRICES, "volume")
REQUIRED = ("date", *PRICES)


class MissingColumns(ValueError):
    """A required bar column is absent."""


def normalize_names(df: DataFrame) -> DataFrame:
    """Strip and lower-case column names."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def require_columns(df: DataFrame, needed: Sequence[str] = REQUIRED) -> DataFrame:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")
    return df


def tolerant_number(column: str) -> Column:
    """Double, or null for text that is not a finite number."""
    number = F.trim(F.col(column).cast("string")).try_cast("double")
    return F.when(~F.isnan(number) & (F.abs(number) != F.lit(float("inf"))), number)


def tolerant_date(column: str) -> Column:
    """The date that a text begins with; a time alone is no date."""
    return F.trim(F.col(column).cast("string")).try_cast("date")


def tolerant_types(df: DataFrame) -> DataFrame:
    """Unreadable dates and numbers become null instead of failing the job."""
    changes = {"date": tolerant_date("date")}
    changes.update({c: tolerant_number(c) for c in NUMBERS if c in df.columns})
    return df.withColumns(changes)


def drop_unused(df: DataFrame, unused: Sequence[str] = ("openint",)) -> DataFrame:
    return df.drop(*unused)


def drop_incomplete(df: DataFrame, subset: Sequence[str] = REQUIRED) -> DataFrame:
    return df.dropna(subset=list(subset))


def since(df: DataFrame, start: str | None = START_DATE, end: str | None = None) -> DataFrame:
    """Period filter; reaches the scan when the source is parquet."""
    if start is not None:
        df = df.where(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col("date") <= F.lit(end).cast("date"))
    return df


def clean(df: DataFrame, start: str | None = START_DATE) -> DataFrame:
    """All loading rules after the read: names, check, types, nulls, period."""
    df = require_columns(normalize_names(df))
    return since(drop_incomplete(drop_unused(tolerant_types(df))), start)


def read_bars(
    spark: SparkSession,
    path: str | Sequence[str],
    start: str | None = START_DATE,
    columns: Sequence[str] | None = None,
    series_from: str = "file",
) -> DataFrame:
    """Read one file or a whole folder of bar files in one scan.

    Columns are found by their names in the header, in any order; files of one
    call share a header (a file with another one raises), so read files of
    another layout by a call of their own. ``columns`` states the header
    instead of reading it from a file.

    ``series_id`` is the file name up to its first dot (``file``: one
    ``<ticker>.us.txt`` per series), a ``series_id=...`` folder (``folder``)
    or a column of that name (``column``).
    """
    if columns is None:
        folders = {"series_id"} if series_from == "folder" else set()
        columns = [c for c in file_columns(spark, path) if c not in folders]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    if series_from == "file":
        raw = raw.select("*", F.lower(F.substring_index(F.col("_metadata.file_name"), ".", 1)).alias("series_id"))
    elif series_from == "folder":
        raw = raw.withColumn("series_id", F.col("series_id").cast("string"))
    elif series_from != "column":
        raise ValueError("series_from must be 'file', 'folder' or 'column'")
    return clean(raw, start).select("series_id", "date", *NUMBERS)


def file_columns(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Header of the first bar file as written."""
    return spark.read.option("header", True).csv(path).columns


def sample_series(df: DataFrame, k: int, seed: int = SEED) -> DataFrame:
    """``k`` series chosen by a portable hash of (id, seed)."""
    ids = df.select("series_id").distinct()
    draw = F.md5(F.concat_ws(",", F.col("series_id"), F.lit(seed).cast("string")))
    return ids.orderBy(draw, "series_id").limit(k)


def in_series(df: DataFrame, ids: DataFrame) -> DataFrame:
    return df.join(ids, "series_id", "left_semi")
