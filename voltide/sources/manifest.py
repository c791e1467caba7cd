"""Folders of bar files with headers of their own: a table of the files first,
then all rows in one scan that places each cell by the header of its file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltide.operators.quality import REPORT_ORDER, qa_report
from voltide.settings import START_DATE
from voltide.sources.bars import NUMBERS, REQUIRED, drop_incomplete, since, tolerant_types


def _address(name: str):
    """Spark writes the same local file with one slash or three."""
    return F.regexp_replace(name, "^file:/+", "file:///").alias("file")


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    lines = spark.read.option("ignoreCorruptFiles", True).text(path)
    return lines.select("value", _address("_metadata.file_path"), F.col("_metadata.file_block_start").alias("_from"))


def cells(line: str, width: int):
    """The line as an array of ``width`` strings, quotes removed; cells that
    the line does not have are null."""
    schema = ", ".join(f"c{i} string" for i in range(width))
    parsed = F.from_csv(line, schema)
    return F.array(*[parsed[f"c{i}"] for i in range(width)])


def file_manifest(spark: SparkSession, path: str | Sequence[str], needed: Sequence[str] = REQUIRED) -> DataFrame:
    """One row per file: ``file, series_id, bytes, header, error``.

    ``series_id`` is the file name up to its first dot, ``header`` the first
    line with text, as trimmed lower-case names. ``error`` says why no row of
    the file can be loaded: ``empty file`` (no byte), ``no readable line``
    (blank or broken), ``missing columns: ...``; otherwise null.

    Sizes come from the listing, contents are not read for them. Headers are looked for in the first
    block of each file only, which costs a scan of those lines without parsing.
    """
    scan = spark.read.format("binaryFile").load(path)
    sizes = scan.select(_address("_metadata.file_path"), "length")
    # Scans skip empty files; the listing, which the driver holds anyway, has them.
    listed = spark.createDataFrame([(f,) for f in scan.inputFiles()], "file string").select(_address("file")).join(sizes, "file", "left")
    listed = listed.select(
        "file",
        F.lower(F.substring_index(F.url_decode(F.substring_index("file", "/", -1)), ".", 1)).alias("series_id"),
        F.coalesce("length", F.lit(0)).alias("bytes"),
    )
    first = (
        _lines(spark, path)
        .where((F.col("_from") == 0) & (F.trim("value") != ""))
        .withColumn("_place", F.monotonically_increasing_id())
        .groupBy("file")
        .agg(F.min_by("value", "_place").alias("_line"))
    )
    names = F.transform(F.split("_line", ","), lambda c: F.lower(F.trim(F.regexp_replace(c, '["﻿]', ""))))
    absent = F.filter(F.array(*[F.lit(c) for c in needed]), lambda c: ~F.array_contains(F.col("header"), c))
    return (
        listed.join(first, "file", "left")
        .withColumn("header", names)
        .select(
            "file",
            "series_id",
            "bytes",
            "header",
            F.when(F.col("bytes") == 0, "empty file")
            .when(F.col("header").isNull(), "no readable line")
            .when(F.size(absent) > 0, F.concat(F.lit("missing columns: "), F.array_join(absent, ", ")))
            .alias("error"),
        )
    )


def read_files(
    spark: SparkSession, path: str | Sequence[str], manifest: DataFrame | None = None, start: str | None = START_DATE
) -> DataFrame:
    """Bars of all files of the manifest without an error; files may differ in
    the order, case and number of their columns. A header line is no bar, as
    its date cannot be read. Several files may hold one series.

    Pass a written ``manifest`` when it is used again."""
    manifest = file_manifest(spark, path) if manifest is None else manifest
    usable = manifest.where(F.col("error").isNull())
    width = usable.agg(F.max(F.size("header"))).first()[0] or 1
    # Places are counted from 1; 0 means that the file lacks the column.
    places = usable.select(
        "file", "series_id", *[F.array_position("header", c).cast("int").alias(f"_at_{c}") for c in ("date", *NUMBERS)]
    )
    rows = _lines(spark, path).join(places, "file").withColumn("_cells", cells("value", width))
    bars = rows.select(
        "series_id", *[F.when(F.col(f"_at_{c}") > 0, F.get("_cells", F.col(f"_at_{c}") - 1)).alias(c) for c in ("date", *NUMBERS)]
    )
    return since(drop_incomplete(tolerant_types(bars)), start).select("series_id", "date", *NUMBERS)


def qa_report_of_files(
    spark: SparkSession, path: str | Sequence[str], manifest: DataFrame | None = None, start: str | None = START_DATE
) -> DataFrame:
    """:func:`qa_report` with a row for every series that a file names. A
    series without a bar carries the error of its files, or ``no bar`` if they
    can be read; its counts are null. Worst first, errors last."""
    manifest = file_manifest(spark, path) if manifest is None else manifest
    report = qa_report(read_files(spark, path, manifest, start)).withColumnRenamed("error", "_none").drop("_none")
    named = manifest.groupBy("series_id").agg(F.min("error").alias("_error"))
    out = named.join(report, "series_id", "left").select(
        *report.columns, F.when(F.col("n_rows").isNull(), F.coalesce("_error", F.lit("no bar"))).alias("error")
    )
    return out.orderBy(*[F.col(c).desc_nulls_last() for c in REPORT_ORDER], "series_id")
