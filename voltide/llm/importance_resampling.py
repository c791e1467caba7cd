"""Target-distribution importance resampling: documents are drawn by how much
likelier their hashed word features are in a target table than in the corpus,
plus Gumbel noise from a hash of the id.

The bucket of a feature is its CRC-32. A task groups the distinct features of a
batch by length, lays those of equal length as rows of a matrix of bytes, and
brings the checksums of all of them forward column by column; buckets are
scattered back to the places of the features.

Counts of corpus and target cover all rows: each task returns one number a
bucket, so what is summed and broadcast is bounded by the number of buckets.
Ranks come from a range partitioning: a row's rank is its place in its partition
plus the rows of the partitions before it; no task ranks all rows.

Cases: null and empty texts, and texts without a word, have no feature and
weight 0; repeated rows are each scored and ranked; a row with a null id has no
noise, hence neither score nor rank, and is no document of the draw; an empty
table gives no rows, an empty target counts as zeros. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.text import ALNUM, column_bytes, row_ranges, word_hashes, word_spans
from voltide.session import materialize

BUCKETS = 10_000
MIN_WORDS = 20
DRAW_PERCENT = 10
SEED = 2024
BATCH_BYTES = 4 << 20
#: Cells of one byte matrix; groups of more are taken in parts.
MATRIX_CELLS = 1 << 24

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, value >> 1 ^ np.uint32(0xEDB88320), value >> 1).astype(np.uint32)
    return value


CRC_TABLE = _crc_table()


def matrix_crcs(rows: np.ndarray) -> np.ndarray:
    """The CRC-32 of each row of a matrix of bytes."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in rows.T:
        crc = CRC_TABLE[(crc ^ column) & np.uint32(255)] ^ crc >> np.uint32(8)
    return ~crc


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each span of bytes, spans of one length at a time."""
    out = np.empty(len(starts), np.uint32)
    size = ends - starts
    order = np.argsort(size, kind="stable")
    lengths, first = np.unique(size[order], return_index=True)
    for length, at in zip(lengths.tolist(), np.split(order, first[1:]), strict=False):
        step = max(1, MATRIX_CELLS // max(1, length))
        for k in range(0, len(at), step):
            part = at[k : k + step]
            out[part] = matrix_crcs(data[starts[part][:, None] + np.arange(length)])
    return out


def run_features(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts, ends and row offsets of the features of rows of lower-case
    text (runs of 1 to ``size`` words joined by a space), and a 64-bit hash of each."""
    starts, ends, rows = word_spans(data, offsets, ALNUM)
    data = _LOWER[data]
    length = ends - starts
    # The words again, each with one space before it: a run of words is a span.
    joined_ends = np.cumsum(length + 1)
    joined_starts = joined_ends - length
    joined = np.full(int(joined_ends[-1]) if len(length) else 0, 32, np.uint8)
    joined[np.repeat(joined_starts - (np.cumsum(length) - length), length) + np.arange(length.sum())] = data[np.repeat(starts - (np.cumsum(length) - length), length) + np.arange(length.sum())]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(rows))
    at, to = [], []
    for n in range(1, size + 1):
        first = np.flatnonzero(row[: len(row) - n + 1] == row[n - 1 :]) if len(row) >= n else np.zeros(0, np.int64)
        at.append(first)
        to.append(first + n - 1)
    first, last = np.concatenate(at), np.concatenate(to)
    order = np.argsort(row[first], kind="stable")
    first, last = first[order], last[order]
    feature_rows = np.searchsorted(row[first], np.arange(len(offsets)))
    s, e = joined_starts[first], joined_ends[last]
    return joined, s, e, feature_rows, word_hashes(joined, s, e, lower=False)


def feature_buckets(texts: pa.Array, size: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For a part of the rows at a time: the buckets of all its features, and the
    n + 1 feature offsets of its rows."""
    data, offsets = column_bytes(texts)
    for lo, hi in row_ranges(offsets, BATCH_BYTES):
        joined, s, e, rows, hashes = run_features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], size)
        _, one, back = np.unique(hashes, return_index=True, return_inverse=True)
        yield (span_crcs(joined, s[one], e[one]) % np.uint32(buckets))[back].astype(np.int64), rows


def bucket_counts(table: DataFrame, text_col: str, size: int, buckets: int) -> np.ndarray:
    """Features in each bucket, over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found, _ in feature_buckets(batch.column("text"), size, buckets):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counts = table.select(F.col(text_col).cast("string").alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in counts.collect():  # a row for each bucket at most
        out[row["bucket"]] = row["n"]
    return out


def log_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, in thousandths."""
    n = len(corpus)
    corpus, target = corpus.astype(np.float64), target.astype(np.float64)
    share = (target + 1) * (corpus.sum() + n) / ((corpus + 1) * (target.sum() + n))
    return np.floor(1000 * np.log(share)).astype(np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text", size: int = 1) -> DataFrame:
    """Per row: ``id``, ``n_features``, ``n_words``, ``weight``."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, weights = [], []
            for found, at in feature_buckets(batch.column("text"), size, len(shared.value)):
                sums = np.concatenate([[0], np.cumsum(shared.value[found])])
                counts.append(np.diff(at))
                weights.append(sums[at[1:]] - sums[at[:-1]])
            n, w = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (counts, weights))
            # A text of n words has n + (n - 1) + ... runs, as far as there are words.
            words = n if size == 1 else _words_of(n, size)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), pa.array(words), pa.array(w)], ["id", "n_features", "n_words", "weight"])

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return d.mapInArrow(rows, f"id {d.schema['id'].dataType.simpleString()}, n_features long, n_words long, weight long")


def _words_of(features: np.ndarray, size: int) -> np.ndarray:
    """Number of words of texts with these numbers of runs of 1 to ``size`` words."""
    full = size * (size + 1) // 2
    short = np.cumsum(np.arange(size + 1))
    return np.where(features >= full, (features + size * (size - 1) // 2) // size, np.searchsorted(short, features))


def ranked(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with ``place``, 1 for the first in this order. The rows are dealt
    to partitions by range and written with their places there."""
    spark = rows.sparkSession
    number = F.monotonically_increasing_id()
    placed = materialize(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("number", number), "ranked")
    # The number of a row is that of its partition times 2 ** 33, and its place.
    part = F.shiftright("number", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    before, total = [], 0
    for row in sizes:  # a row for each partition
        before.append((row["part"], total))
        total += row["n"]
    offsets = F.broadcast(spark.createDataFrame(before or [(0, 0)], "part long, before long"))
    rank = F.col("before") + F.col("number").bitwiseAND((1 << 33) - 1) + 1
    return placed.withColumn("part", part).join(offsets, "part").withColumn("place", rank).drop("part", "before", "number")


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 1, buckets: int = BUCKETS,
    min_words: int = MIN_WORDS, percent: int = DRAW_PERCENT, seed: int = SEED,
) -> DataFrame:
    """Per row: id, ``n_features``, ``weight``, ``score``, and ``rank`` from 1 for
    the rows drawn (null for others): ``percent`` of the documents of
    ``min_words`` words or more, those of the highest scores."""
    gains = log_gains(bucket_counts(docs, text_col, size, buckets), bucket_counts(target, text_col, size, buckets))
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256), 1, 8), 16, 10).cast("double")
    gumbel = F.floor(-1000 * F.log(-F.log((noise + 0.5) / 4294967296.0)))
    scored = materialize(weigh(docs, gains, id_col, text_col, size).withColumn("score", F.col("weight") + gumbel), "weights")
    able = (F.col("n_words") >= min_words) & F.col("score").isNotNull()
    drawn = scored.where(able).count() * percent // 100
    places = ranked(scored.where(able), F.desc("score"), "id", "n_features")
    places = places.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))).drop("place")
    others = scored.where(~F.coalesce(able, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return places.unionByName(others).select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank")
