"""Set similarity join: documents whose sets of word shingles have a Jaccard
similarity of at least ``percent`` / 100, and the components of these links.

Equal sets are collapsed first. The distinct sets are dealt to size-banded
tiles: for the smaller set x of a linked pair the symmetric difference is at
most |x| (100 - t) / t, so if the hash range is cut into more segments than
that, the two sets agree on a whole segment. A tile holds the sets of a band
(and the larger ones within reach) that agree on one segment. Inside a tile,
parity bitmaps bound the overlap from above: the number of unequal
bits never exceeds the symmetric difference. Pairs that survive are compared by
exact intersection of the sorted sets.

Two passes keep the number of comparisons linear where copies abound and still
lose no link. The first pairs each member of a tile with the least one: the tiles
that copies share name the same pairs over and over, so few distinct pairs are
left, and bitmaps are looked up for these alone. The second takes every pair
that the bitmaps allow in a tile, lies between different components and was
not compared before. Large tiles are cut into blocks of members by hash, block
against block.

Cases: null and empty texts, and texts without a word, have no shingle and link
with nothing; a text of fewer words than a shingle is one shingle; repeated rows
are each returned. Rows that share an id but not a text are compared by the
greatest of these texts. A row with a null id gets the component of its set, if
other rows have that set, else null.

Sets hold 64-bit hashes of shingles; equality of whole sets is tested on a
128-bit digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltide.llm.components import connected_components
from voltide.llm.text import NOT_BLANK, U64, column_bytes, mix, row_ranges, shingle_hashes, word_hashes, word_spans
from voltide.session import discard, materialize, release

MIN_BITS = 512
BAND_RATIO = 1.5
TILE_BLOCK = 1024
BATCH_BYTES = 8 << 20
#: Segment keys that a task holds before it looks for those met twice.
HELD_KEYS = 1 << 21
#: Words of 64 bits that tell which ids are wanted.
ID_WORDS = 1 << 18
#: What a task knows of a key and row.
SINGLE, MARK, MEMBER = 0, 1, 2


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    data, offsets = column_bytes(texts)
    for lo, hi in row_ranges(offsets, BATCH_BYTES):
        part = data[offsets[lo] : offsets[hi]]
        starts, ends, rows = word_spans(part, offsets[lo : hi + 1] - offsets[lo], NOT_BLANK)
        words = word_hashes(part, starts, ends)
        for r in range(hi - lo):
            yield np.unique(shingle_hashes(words[rows[r] : rows[r + 1]], size))


def parity_bitmap(values: np.ndarray, wide: bool = False, percent: int = 90) -> bytes:
    """Bit i tells whether an odd number of values fall on i. Unlike sets differ in
    about half of the bits, and there are more than four times as many bits as linked
    sets of this size may differ in, so hardly a pair of unlike sets passes; every
    tile of a set carries its bitmap, so more bits than that would cost more than they
    save there. A ``wide`` one has four times as many: pairs of sets that are still
    left look at these."""
    differ = 2 * len(values) * (100 - percent) // (100 + percent)
    bits = max(MIN_BITS, 1 << (4 * differ).bit_length()) * (4 if wide else 1)
    odd = np.bincount((values >> U64(20)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def folded(bitmaps: list[bytes]) -> np.ndarray:
    """Bitmaps of several widths as rows of 64-bit words of the least width:
    the parities of the halves add up to the parity of the narrower bitmap."""
    least = min(map(len, bitmaps))
    rows = [np.bitwise_xor.reduce(np.frombuffer(b, U64).reshape(-1, least // 8)) for b in bitmaps]
    return np.stack(rows)


class Bands:
    """Size bands and the segment keys of a set in each band it belongs to."""

    def __init__(self, percent: int):
        self.percent = percent
        self.low = [1]
        self.parts: dict[int, tuple[int, int, np.ndarray]] = {}

    def band(self, size: int) -> int:
        while self.low[-1] <= size:
            self.low.append(max(self.low[-1] + 1, int(self.low[-1] * BAND_RATIO)))
        return int(np.searchsorted(self.low, size, "right")) - 1

    def segments(self, band: int) -> tuple[int, int, np.ndarray]:
        """Number of segments, of segments beyond the largest difference, and
        the bounds of the segments in the hash range."""
        if band not in self.parts:
            while band + 1 >= len(self.low):
                self.band(self.low[-1])
            most = (self.low[band + 1] - 1) * (100 - self.percent) // self.percent
            spare = 0 if most == 0 else 2 + most // 32
            n = most + 1 + spare
            bounds = np.array([(k << 64) // n for k in range(1, n)], U64)
            self.parts[band] = n, spare, bounds
        return self.parts[band]

    def keys(self, values: np.ndarray) -> np.ndarray:
        size = len(values)
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(values + U64(0x9E3779B97F4A7C15)))])
        out = []
        for band in range(self.band(-(-size * self.percent // 100)), self.band(size) + 1):
            n, spare, bounds = self.segments(band)
            at = np.concatenate([[0], np.searchsorted(values, bounds), [size]])
            key = sums[at[1:]] - sums[at[:-1]] + (np.arange(n, dtype=U64) + U64(band << 32)) * U64(0xD6E8FEB86659FD93)
            empty = at[1:] == at[:-1]
            # With no more empty segments than spare ones, a pair also agrees on a filled one.
            out.append(key if empty.sum() > spare else key[~empty])
        return mix(np.concatenate(out))


def known_tiles(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the keys of some rows: tile, row and kind. A key that two rows have is a
    tile already: its members are ``MEMBER``, and one ``MARK`` tells other tasks.
    Any other is a tile only if another task has it too (``SINGLE``)."""
    order = np.lexsort((rows, keys))
    keys, rows = keys[order], rows[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    keys, rows = keys[fresh], rows[fresh]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(keys)))
    kind = np.repeat(np.where(size > 1, MEMBER, SINGLE), size)
    marks = first[size > 1]
    return np.concatenate([keys, keys[marks]]), np.concatenate([rows, rows[marks]]), np.concatenate([kind, np.full(len(marks), MARK)])


def sketch(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """Per row: id, set size, digest and two bitmaps (where a task meets the digest
    for the first time in a row with an id); and for the segment keys of these rows
    ``tile``, id and ``kind`` (see ``known_tiles``)."""
    names = ["id", "n", "digest", "bitmap", "wide", "tile", "kind"]
    kinds = [None, pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int8()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, met, held, held_ids, n_held, id_kind = Bands(percent), set(), [], [], 0, None

        def batch_of(size: int, **columns) -> pa.RecordBatch:
            arrays = [pa.array(columns[k], t or id_kind) if k in columns else pa.nulls(size, t or id_kind) for k, t in zip(names, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        def flush() -> Iterator[pa.RecordBatch]:
            keys, at, kind = known_tiles(np.concatenate(held), np.repeat(np.arange(len(held)), [len(k) for k in held]))
            # The keys of a row together: files and shuffles hardly spend bytes on its id.
            by_row = np.argsort(at, kind="stable")
            keys, at, kind = keys[by_row], at[by_row], kind[by_row]
            ids = pa.array(held_ids, id_kind)
            for k in range(0, len(keys), 1 << 16):
                part = slice(k, k + (1 << 16))
                yield batch_of(len(keys[part]), id=ids.take(pa.array(at[part])).to_pylist(), tile=keys[part].view(np.int64), kind=kind[part])

        for batch in batches:
            id_kind = batch.schema.field("id").type
            sizes, digests, bitmaps, wides = [], [], [], []
            ids = batch.column("id").to_pylist()
            for values, own in zip(shingle_sets(batch.column("text"), shingle), ids, strict=True):
                sizes.append(len(values))
                digest = hashlib.blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None
                new = digest is not None and own is not None and digest not in met
                digests.append(digest)
                bitmaps.append(parity_bitmap(values, percent=percent) if new else None)
                wides.append(parity_bitmap(values, wide=True, percent=percent) if new else None)
                if new:
                    met.add(digest)
                    held.append(bands.keys(values))
                    held_ids.append(own)
                    n_held += len(held[-1])
                if n_held > HELD_KEYS:
                    yield from flush()
                    held, held_ids, n_held = [], [], 0
            yield batch_of(len(ids), id=ids, n=sizes, digest=digests, bitmap=bitmaps, wide=wides)
        if held:
            yield from flush()

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    return d.mapInArrow(rows, f"id {kind}, n long, digest binary, bitmap binary, wide binary, tile long, kind byte")


def tiles_of(sketches: DataFrame) -> DataFrame:
    """``tile``, ``id``, ``n_members``, ``least``: the tiles with two members or
    more; of tiles with the same members only one.

    A key reaches the shuffle once for each task that has it (and its flush), so a
    key of very many rows is no large group there."""
    found = sketches.where("tile IS NOT NULL").select("tile", "id", "kind")
    tile = Window.partitionBy("tile")
    single = found.where(F.col("kind") != MEMBER).withColumns({"_n": F.count(F.lit(1)).over(tile), "_known": F.max("kind").over(tile)})
    single = single.where((F.col("kind") == SINGLE) & ((F.col("_n") > 1) | (F.col("_known") == MARK)))
    members = found.where(F.col("kind") == MEMBER).select("tile", "id").union(single.select("tile", "id"))
    members = materialize(members.distinct(), "tile-members")
    release(sketches.sparkSession)
    same = members.groupBy("tile").agg(
        F.count("*").alias("n_members"), F.min("id").alias("least"), F.bit_xor(F.xxhash64("id")).alias("h"), F.bit_xor(F.xxhash64("id", F.lit(7))).alias("g")
    )
    once = same.where("n_members > 1").groupBy("n_members", "least", "h", "g").agg(F.min("tile").alias("tile")).select("tile", "n_members", "least")
    tiles = materialize(members.join(materialize(once, "distinct-tiles"), "tile"), "tiles")
    discard(members)
    release(sketches.sparkSession)
    return tiles


def bitmaps_of(sets: DataFrame, bitmap: str = "bitmap") -> DataFrame:
    """``id``, ``n``, ``bitmap`` of the set of each id that has one."""
    known = sets.where(F.col(bitmap).isNotNull()).groupBy("id").agg(F.max(F.struct("n", bitmap)).alias("s"))
    return known.select("id", F.col("s.n").alias("n"), F.col(f"s.{bitmap}").alias("bitmap"))


def least_pairs(tiles: DataFrame) -> DataFrame:
    """``x``, ``y``: each member of a tile with the least one."""
    return tiles.where("id <> least").select(F.col("least").alias("x"), F.col("id").alias("y")).distinct()


def allowed_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps leave room for enough overlap: first the narrow ones,
    which are small enough to travel with every pair, then the wide ones."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(f"{k}_s") for k in "xy")
            n, m = (c.field("n").to_numpy(zero_copy_only=False) for c in (a, b))
            differ = np.array([np.bitwise_count(np.bitwise_xor(*folded(list(two)))).sum() for two in zip(a.field("bitmap").to_pylist(), b.field("bitmap").to_pylist(), strict=True)], np.int64)
            most = np.minimum((n + m - differ) // 2, np.minimum(n, m))
            yield batch.select(["x", "y"]).filter(pa.array((100 + percent) * most >= percent * (n + m)))

    for bitmap in ("bitmap", "wide"):
        marks = bitmaps_of(sets, bitmap)
        x, y = (marks.select(F.col("id").alias(k), F.struct("n", "bitmap").alias(f"{k}_s")) for k in "xy")
        pairs = pairs.join(x, "x").join(y, "y").select("x", "y", "x_s", "y_s").mapInArrow(check, pairs.schema)
    return pairs


def candidates(tiles: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of tile members, not of one component, that the bitmaps allow."""
    marks = bitmaps_of(sets)
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    other = F.when(F.col("blocks") == 1, F.array(F.lit(0).cast("long"))).otherwise(
        F.array_remove(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), F.col("block"))
    )
    m = tiles.withColumn("blocks", F.ceil(F.col("n_members") / TILE_BLOCK).cast("long")).withColumn("block", block)
    m = m.withColumn("other", F.explode(other)).join(marks, "id")
    pair = [F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q")]
    groups = m.groupBy("tile", *pair).agg(F.collect_list(F.struct("id", "component", "n", "bitmap")).alias("members")).select("members")

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column("members")
            at, flat = members.offsets.to_numpy(), members.values
            ids, comps, n = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("id", "component", "n"))
            bitmaps = flat.field("bitmap").to_pylist()
            xs, ys = [], []
            for a, b in zip(at[:-1], at[1:], strict=True):
                x, y = allowed(comps[a:b], n[a:b], folded(bitmaps[a:b]), percent)
                xs.append(ids[a + x])
                ys.append(ids[a + y])
            x, y = np.concatenate(xs), np.concatenate(ys)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["x", "y"])

    kind = tiles.schema["id"].dataType.simpleString()
    return groups.mapInArrow(pairs, f"x {kind}, y {kind}").distinct()


def allowed(comps: np.ndarray, n: np.ndarray, words: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs between components whose overlap may be large enough."""
    xs, ys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(len(n) - 1):
        differ = np.bitwise_count(words[i] ^ words[i + 1 :]).sum(1, dtype=np.int64)
        both = n[i] + n[i + 1 :]
        most = np.minimum((both - differ) // 2, np.minimum(n[i], n[i + 1 :]))
        j = np.flatnonzero((comps[i] != comps[i + 1 :]) & ((100 + percent) * most >= percent * both))
        xs.append(np.full(len(j), i))
        ys.append(j + i + 1)
    return np.concatenate(xs), np.concatenate(ys)


def wanted_rows(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is one of ``ids`` (distinct). Each of these sets a
    bit of a table of fixed size that every task gets, so hardly a row that nobody
    asks for is shuffled. (Spark would push a semi join below the look at the bits.)"""
    h = F.xxhash64("id")
    word, bit = F.pmod(h, F.lit(ID_WORDS)).alias("_word"), F.pmod(F.shiftright(h, 32), F.lit(64))
    marks = ids.select(word, bit.cast("int").alias("_bit")).groupBy("_word").agg(F.expr("bit_or(shiftleft(1L, _bit))").alias("_bits"))
    likely = docs.withColumn("_word", word).join(F.broadcast(marks), "_word").where(F.getbit("_bits", bit) == 1).select(docs.columns)
    return likely.join(ids, "id").select(docs.columns)


def linked(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose sets really overlap enough."""
    side = lambda k: texts.select(F.col("id").alias(k), F.col("text").alias(f"{k}_text"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for a, b in zip(*(shingle_sets(batch.column(f"{k}_text"), shingle) for k in "xy"), strict=True):
                common = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["x", "y"]).filter(pa.array(ok, pa.bool_()))

    return pairs.join(side("x"), "x").join(side("y"), "y").select("x", "y", "x_text", "y_text").mapInArrow(verify, pairs.schema)


def similarity_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, percent: int = 90) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (the least id linked with
    it, directly or not)."""
    sketches = materialize(sketch(docs, id_col, text_col, shingle, percent), "sketches")
    tiles = tiles_of(sketches)
    # The keys are most of that table and no longer needed.
    sets = materialize(sketches.where("tile IS NULL").drop("tile", "kind"), "sets")
    discard(sketches)
    first = materialize(sets.where("digest IS NOT NULL").groupBy("digest").agg(F.min("id").alias("rep")), "set-classes")
    rows = materialize(sets.select("id", "n", "digest").join(first, "digest", "left").select("id", "n", F.coalesce("rep", "id").alias("rep")), "set-rows")
    rep = rows.where("id IS NOT NULL AND n > 0").groupBy("id").agg(F.min("rep").alias("rep"))
    release(docs.sparkSession)

    def links_of(pairs: DataFrame, name: str) -> DataFrame:
        """The pairs that are links, between representatives of equal sets."""
        likely = materialize(allowed_pairs(pairs, sets, percent), f"{name}-pairs")
        release(docs.sparkSession)
        ids = likely.select(F.explode(F.array("x", "y")).alias("id")).distinct()
        texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        texts = materialize(wanted_rows(texts, ids).groupBy("id").agg(F.max("text").alias("text")), f"{name}-texts")
        release(docs.sparkSession)
        ends = linked(likely, texts, shingle, percent).join(rep.select(F.col("id").alias("x"), F.col("rep").alias("u")), "x")
        links = materialize(ends.join(rep.select(F.col("id").alias("y"), F.col("rep").alias("v")), "y").select("u", "v"), f"{name}-links")
        discard(likely, texts)
        release(docs.sparkSession)
        return links

    tried = materialize(least_pairs(tiles), "least-pairs")
    links = links_of(tried, "first")
    found = materialize(connected_components(links), "first-components")
    release(docs.sparkSession)

    labelled = tiles.join(rep, "id")
    labelled = labelled.join(found, labelled["rep"] == found["node"], "left").select("tile", "id", "n_members", F.coalesce("component", "rep").alias("component"))
    labelled = materialize(labelled.where("n_members > 2"), "labelled-tiles")
    open_tiles = labelled.groupBy("tile").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b").select("tile")
    rest = materialize(candidates(labelled.join(open_tiles, "tile", "left_semi"), sets, percent), "open-pairs")
    discard(labelled, tiles)
    release(docs.sparkSession)
    more = links_of(rest.join(tried, ["x", "y"], "left_anti"), "more")
    found = connected_components(links.union(more))
    discard(first, sets, tried, rest, links, more)

    out = rows.join(found, rows["rep"] == found["node"], "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, with one row left of each component:
    the one with its least id. Texts without a word stay; of rows that share an
    id the one with the greatest text stays; rows with a null id, which name no document, all stay."""
    found = similarity_classes(docs, id_col, text_col, **options)
    least = found.where(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    # Of rows that share an id the greatest text was compared, so it stays; further
    # ties fall by a hash of all columns.
    own = Window.partitionBy(id_col).orderBy(F.col(text_col).desc_nulls_last(), F.xxhash64(*docs.columns))
    place = "_place_of_row"
    one = docs.join(least, id_col, "left_semi").withColumn(place, F.row_number().over(own)).where(F.col(place) == 1).drop(place)
    return one.unionByName(docs.where(F.col(id_col).isNull()))
