"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of 13 consecutive item words (an item of fewer words is
one window). Patterns of equal length share the classic three tables, with
words as symbols: a shift table over hashed two-word blocks skips positions
where no pattern can end, a suffix-hash bucket lists the patterns that may end
there, and a comparison of the words themselves confirms an occurrence. Texts
are cut into lanes that numpy moves forward together.

Cases: a null or empty text has no words and no hits; items without words give
no pattern; equal items and equal windows are all reported; a null item id is
the empty string; an empty benchmark leaves every document clean. Only the id
and the text are read, so further columns of any name do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltide.llm.text import ALNUM, U64, column_bytes, row_ranges, word_hashes, word_spans

WINDOW = 13
#: Benchmark text that one set of tables covers; a larger benchmark is searched
#: for block by block.
BLOCK_BYTES = 32 << 20
LANE = 1024
BATCH_BYTES = 8 << 20


def _block_hash(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    return ((left * U64(0x9E3779B97F4A7C15) + right) >> U64(64 - bits)).astype(np.int64)


class _Tables:
    """Shift table, suffix buckets and words of all patterns of one length."""

    def __init__(self, hashes: np.ndarray, words: list[tuple[bytes, ...]], items: list[list[int]]):
        self.words, self.items, self.length = words, items, hashes.shape[1]
        m = self.length
        self.span = min(2, m)
        self.bits = max(12, min(22, int(hashes.size * 8).bit_length()))
        self.shift = np.full(1 << self.bits, m - self.span + 1, np.int64)
        for j in range(self.span, m + 1):
            np.minimum.at(self.shift, self._block(hashes[:, j - self.span : j]), m - j)
        last = self._block(hashes[:, m - self.span :])
        order = np.argsort(last, kind="stable")
        self.hashes, self.order = hashes[order], order
        self.first = np.searchsorted(last[order], np.arange((1 << self.bits) + 1))

    def _block(self, pair: np.ndarray) -> np.ndarray:
        left = pair[:, 0] if self.span == 2 else np.zeros(len(pair), U64)
        return _block_hash(left, pair[:, -1], self.bits)

    def ends(self, hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Word positions at which the shift table lets a pattern end."""
        m = self.length
        begin, stop = offsets[:-1] + m - 1, offsets[1:]
        lanes = np.maximum(0, -(-(stop - begin) // LANE))
        doc = np.repeat(np.arange(len(lanes)), lanes)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = begin[doc] + nth * LANE
        until = np.minimum(at + LANE, stop[doc])
        found = []
        while len(at):
            left = hashes[at - 1] if self.span == 2 else np.zeros(len(at), U64)
            step = self.shift[_block_hash(left, hashes[at], self.bits)]
            found.append(at[step == 0])
            at = at + np.maximum(step, 1)
            live = at < until
            at, until = at[live], until[live]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def matches(self, hashes: np.ndarray, offsets: np.ndarray, word) -> Iterator[tuple[int, int]]:
        """(first word, pattern) of every confirmed occurrence."""
        end = self.ends(hashes, offsets)
        left = hashes[end - 1] if self.span == 2 else np.zeros(len(end), U64)
        bucket = _block_hash(left, hashes[end], self.bits)
        size = self.first[bucket + 1] - self.first[bucket]
        end = np.repeat(end, size)
        nth = np.arange(len(end)) - np.repeat(np.cumsum(size) - size, size)
        pattern = np.repeat(self.first[bucket], size) + nth
        for k in range(self.length):
            same = hashes[end - self.length + 1 + k] == self.hashes[pattern, k]
            end, pattern = end[same], pattern[same]
        for e, p in zip(end.tolist(), self.order[pattern].tolist(), strict=True):
            start = e - self.length + 1
            if all(word(start + k) == w for k, w in enumerate(self.words[p])):
                yield start, p


class WuManber:
    """Search tables of one block of benchmark items."""

    def __init__(self, ids: list[str | None], texts: pa.Array, window: int = WINDOW):
        data, offsets = column_bytes(texts)
        starts, ends, rows = word_spans(data, offsets, ALNUM)
        hashes = word_hashes(data, starts, ends)
        low = data.tobytes().lower()
        self.ids = sorted({"" if i is None else str(i) for i in ids})
        number = {x: k for k, x in enumerate(self.ids)}
        found: dict[int, dict[tuple[bytes, ...], tuple[np.ndarray, list[int]]]] = {}
        for r, item in enumerate(ids):
            a, b = int(rows[r]), int(rows[r + 1])
            size = min(window, b - a)
            for s in range(a, b - size + 1) if size else ():
                key = tuple(low[starts[k] : ends[k]] for k in range(s, s + size))
                found.setdefault(size, {}).setdefault(key, (hashes[s : s + size], []))[1].append(number["" if item is None else str(item)])
        self.tables = [_Tables(np.stack([h for h, _ in x.values()]), list(x), [sorted(set(i)) for _, i in x.values()]) for x in found.values()]

    def scan(self, texts: pa.Array) -> Iterator[tuple[int, list[tuple[int, int]], list[str]]]:
        """For each text: its number of words, the merged word spans that are
        hit, and the ids of the items with an occurring window."""
        data, offsets = column_bytes(texts)
        for lo, hi in row_ranges(offsets, BATCH_BYTES):
            own = offsets[lo : hi + 1] - offsets[lo]
            part = data[offsets[lo] : offsets[hi]]
            starts, ends, rows = word_spans(part, own, ALNUM)
            hashes = word_hashes(part, starts, ends)
            word = lambda k, p=part, s=starts, e=ends: p[s[k] : e[k]].tobytes().lower()
            spans: dict[int, list[tuple[int, int]]] = {}
            items: dict[int, set[int]] = {}
            for t in self.tables:
                for at, pattern in t.matches(hashes, rows, word):
                    r = int(np.searchsorted(rows, at, "right")) - 1
                    spans.setdefault(r, []).append((at - int(rows[r]), at - int(rows[r]) + t.length))
                    items.setdefault(r, set()).update(t.items[pattern])
            for r in range(hi - lo):
                yield int(rows[r + 1] - rows[r]), merged(spans.get(r, [])), sorted(self.ids[i] for i in items.get(r, ()))


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_ARROW_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[tuple[list[str | None], pa.Array]]:
    """The benchmark in blocks of about ``limit`` bytes, one at a time."""
    items = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).where(F.col("t").isNotNull())
    total = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, math.ceil(total / limit))
    for k in range(n):
        block = items if n == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        table = block.toArrow()
        yield table["i"].to_pylist(), table["t"].combine_chunks() if table.num_rows else pa.array([], pa.string())


def match_documents(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: id, ``n_words``, ``spans`` (merged word spans that occur in
    the benchmark, end exclusive) and ``items`` (ids, sorted as strings).

    A narrow job: no shuffle. Each benchmark block is a broadcast of at most
    ``block_bytes`` of item text; spans of earlier blocks are carried along."""
    spark = docs.sparkSession
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = out.withColumns({"n_words": F.lit(0).cast("long"), "spans": F.array().cast(T.ArrayType(_SPAN)), "items": F.array().cast("array<string>")})
    schema = out.schema
    for ids, texts in _blocks(benchmark, item_col, item_text_col, block_bytes):
        tables = spark.sparkContext.broadcast(WuManber(ids, texts, window))

        def search(batches: Iterator[pa.RecordBatch], tables=tables) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n_words, spans, items = [], [], []
                known = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)
                for (n, s, i), (old_s, old_i) in zip(tables.value.scan(batch.column("text")), known, strict=True):
                    n_words.append(n)
                    spans.append([{"start": a, "end": b} for a, b in merged(s + [(x["start"], x["end"]) for x in old_s])])
                    items.append(sorted({*i, *old_i}))
                cols = [batch.column("id"), batch.column("text"), pa.array(n_words, pa.int64()), pa.array(spans, _ARROW_SPAN), pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(cols, ["id", "text", "n_words", "spans", "items"])

        out = out.mapInArrow(search, schema)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    out = out.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), "spans", "items")
    return out.withColumn("contaminated", is_contaminated(F.col("n_hit"), F.col("n_words")))


def is_contaminated(n_hit, n_words):
    """At least one word is hit, and at least a twentieth of all words."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not contaminated."""
    packed = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    found = match_documents(packed, benchmark, id_col="row", text_col="text", **options)
    return found.where(~F.col("contaminated")).select("row.*")
