"""Alignment of two tokenizers: which tokens of one overlap which of the other,
how often each pair of ids is linked in the corpus, and whether a link's count is
the highest of its id.

Tokens A and B of a text cover the same bytes. Every byte offset where a token of
either ends closes one link, that of the two tokens it lies in; offsets where
both end close a group.

Counting pairs spills to runs outside the tasks. A task gathers records (B id, A
id, document, links) up to a bound, sorts them side-major, that is by B id first,
deals them to radix partitions of the B id, and writes a zstd run for each. For each
radix partition the pair lists of its runs are merged by a heap over the
next B id of each run: this counts a pair over all runs, and when a B id is done,
its maximum is known. The runs are then streamed past these counts, and what each
gives its documents is summed and sent back to them. Pair lists hold a pair once,
however many documents have it, so a common pair is no hot key there; the runs of a
large radix partition are dealt to several tasks.

The chunks of a text between white spaces are encoded independently by both
tokenizers (the vocabularies are checked for tokens across), and a bounded
memory holds what is known of chunks met before.

Cases: null and empty texts have no tokens, nor has a text whose bytes are not
those of the tokens of A or B: zeros and an empty digest; strings of special
tokens are plain text; repeated rows and rows that share an id or have none count
one by one; an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.chunks import ChunkMemory, chunk_text, spaced_chunks, text_batches
from voltide.session import materialize

SPACE = "▁"
#: Radix partitions of the B ids.
RADIX = 256
#: Records gathered for one set of runs, and documents in it.
RUN_RECORDS = 2_000_000
RUN_DOCUMENTS = 1 << 16
#: Chunks that a worker remembers.
MEMORY_CHUNKS = 300_000
#: Runs that one merge reads at a time; what it has merged counts as one.
FAN_IN = 64
#: Bytes of a radix partition's runs that one task streams.
TASK_BYTES = 64 << 20
#: Documents whose sums a task holds.
HELD_DOCUMENTS = 2_000_000

# A record is one number: B id, A id, document and links, from high to low bits.
ID_BITS, DOC_BITS, LINK_BITS = 18, 16, 12
LINK_MASK = (1 << LINK_BITS) - 1
DOC_MASK = (1 << DOC_BITS) - 1


def byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for:
    printable ones stand for themselves, others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class TokenPair:
    """Both tokenizers and what they make of chunks."""

    def __init__(self, model_a: bytes, model_b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(model_a)
        self.a.encode_special_tokens = True
        value, names = byte_values(), json.loads(model_a)["model"]["vocab"]
        self.a_size = np.zeros(max(names.values()) + 1, np.int64)
        self.a_bytes = [b""] * len(self.a_size)
        for name, i in names.items():
            self.a_size[i], self.a_bytes[i] = len(name), bytes(value[c] for c in name)
        self.b = sp = sentencepiece.SentencePieceProcessor(model_proto=model_b)
        self.b_bytes = [self._piece_bytes(sp, i) for i in range(sp.vocab_size())]
        self.b_size = np.array([len(x) for x in self.b_bytes])
        if max(len(self.a_size), len(self.b_size)) > 1 << ID_BITS:
            raise ValueError(f"only vocabularies of up to {1 << ID_BITS} ids are supported")
        inner = {p[k : k + 2] for p in map(sp.id_to_piece, range(sp.vocab_size())) for k in range(len(p) - 1)}
        if any(pair[1] == "\n" or (pair[1] == SPACE and pair[0] != SPACE) for pair in inner):
            raise ValueError("only vocabularies without pieces across spaces and line feeds are supported")
        self.line = len(sp.encode("\n"))
        self.memory = ChunkMemory(self.encode, MEMORY_CHUNKS)

    @staticmethod
    def _piece_bytes(sp, i: int) -> bytes:
        return bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) or sp.is_unknown(i) else sp.id_to_piece(i).replace(SPACE, " ").encode()

    def _b_ids(self, keys: list[str]) -> list[list[int]]:
        # The library sets a space before every text. Other chunks follow a line
        # feed, which no piece spans, and lose what belongs to it.
        spaced = lambda k: chunk_text(k)[0] == " "
        found = self.b.encode([chunk_text(k)[1:] if spaced(k) else "\n" + k for k in keys], num_threads=1)
        # A lone space is no text to the library.
        lone = self.b.piece_to_id(SPACE)
        return [ids if spaced(k) and ids else [lone] if spaced(k) else ids[self.line :] for k, ids in zip(keys, found, strict=True)]

    def encode(self, keys: list[str]) -> tuple[list, ...]:
        """Per chunk: whether the bytes agree, number of A and B ids and groups,
        the groups as text, and the linked pairs as records."""
        texts = [chunk_text(k) for k in keys]
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self._b_ids(keys)
        good = [b"".join(map(self.a_bytes.__getitem__, x)) == (raw := t.encode()) == b"".join(map(self.b_bytes.__getitem__, y)) for x, y, t in zip(a, b, texts, strict=True)]
        a, b = ([ids if ok else [] for ids, ok in zip(side, good, strict=True)] for side in (a, b))
        n_a, n_b = (np.array([len(ids) for ids in side], np.int64) for side in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(side), np.int64) for side in (a, b))
        ends_a, ends_b = np.cumsum(self.a_size[ids_a]), np.cumsum(self.b_size[ids_b])
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        ends = np.union1d(ends_a, ends_b)
        links = (ids_b[np.searchsorted(ends_b, ends)] << ID_BITS | ids_a[np.searchsorted(ends_a, ends)]) << DOC_BITS + LINK_BITS
        # Bytes of the chunks so far: groups and links end where their chunk does.
        size = np.zeros(len(keys), np.int64)
        size[np.array(good, bool)] = [len(t.encode()) for t, ok in zip(texts, good, strict=True) if ok]
        stop = np.cumsum(size)
        group_at, link_at = (np.concatenate([[0], np.searchsorted(x, stop, "right")]) for x in (both, ends))
        names_a, names_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        cut_a, cut_b = ([0, *(np.searchsorted(x, both) + 1).tolist()] for x in (ends_a, ends_b))
        groups = [f"{','.join(names_a[p:q])}|{','.join(names_b[r:s])}" for p, q, r, s in zip(cut_a, cut_a[1:], cut_b, cut_b[1:], strict=False)]
        g, k = group_at.tolist(), link_at.tolist()
        spelled = [";".join(groups[p:q]) for p, q in zip(g, g[1:], strict=False)]
        raw = links.tobytes()
        pairs = [raw[8 * p : 8 * q] for p, q in zip(k, k[1:], strict=False)]
        return good, n_a.tolist(), n_b.tolist(), np.diff(group_at).tolist(), spelled, pairs


_PAIRS: dict[str, TokenPair] = {}


def token_pair(model_a: bytes, model_b: bytes) -> TokenPair:
    """One for a worker and pair of models."""
    key = hashlib.sha256(model_a).hexdigest() + hashlib.sha256(model_b).hexdigest()
    if key not in _PAIRS:
        _PAIRS[key] = TokenPair(model_a, model_b)
    return _PAIRS[key]


def combined(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pair-document records, in side-major order, and their links."""
    records.sort()
    key = records >> np.uint64(LINK_BITS)
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    links = np.add.reduceat((records & np.uint64(LINK_MASK)).astype(np.int64), first) if len(key) else np.zeros(0, np.int64)
    return key[first], links


def packed(*columns: np.ndarray) -> bytes:
    """Columns of unsigned numbers as one zstd block: their bytes apart, least first."""
    parts = [struct.pack("<I", len(columns[0]))]
    for c in columns:
        width = max(1, (int(c.max()).bit_length() + 7) // 8) if len(c) else 1
        planes = np.ascontiguousarray(c.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width]
        parts += [bytes([width]), np.ascontiguousarray(planes.T).tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpacked(block: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(block)
    (n,), at, out = struct.unpack_from("<I", raw), 4, []
    while at < len(raw):
        width = raw[at]
        planes = np.zeros((n, 8), np.uint8)
        planes[:, :width] = np.frombuffer(raw, np.uint8, n * width, at + 1).reshape(width, n).T
        out.append(planes.view("<u8").ravel().astype(np.int64))
        at += 1 + n * width
    return out


def runs_of(records: np.ndarray, radix: int) -> Iterator[tuple[int, bytes, bytes]]:
    """Radix partition, pair list and documents of each run of these records.
    A pair list has B id, A id, number of records and links of each pair; the
    documents of a run are the steps from one to the next, and the links."""
    key, links = combined(records)
    # Low bits of the B id name the radix partition.
    part = ((key >> np.uint64(DOC_BITS + ID_BITS)) % np.uint64(radix)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    part, key, links = part[order], key[order].astype(np.int64), links[order]
    del order
    at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
    for s, e in zip(at.tolist(), [*at[1:].tolist(), len(part)], strict=True):
        p, doc, n = key[s:e] >> DOC_BITS, key[s:e] & DOC_MASK, links[s:e]
        first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        listed = packed(p[first] >> ID_BITS, p[first] & ((1 << ID_BITS) - 1), np.diff(np.append(first, len(p))), np.add.reduceat(n, first))
        yield int(part[s]), listed, packed(np.diff(doc, prepend=0) & DOC_MASK, n)


def encode_documents(docs: DataFrame, model_a: bytes, model_b: bytes, id_col: str, text_col: str, radix: int) -> DataFrame:
    """A row for each document (``key`` is set) and for each run (``part`` is set)."""
    context = docs.sparkSession.sparkContext
    models = context.broadcast((model_a, model_b))
    names = ["id", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "run", "part", "pairs", "documents"]
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    kinds = [None, *[pa.int64()] * 5, pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def batch_of(id_kind: pa.DataType, n: int, **columns) -> pa.RecordBatch:
        arrays = [pa.array(columns[k], t or id_kind) if k in columns else pa.nulls(n, t or id_kind) for k, t in zip(names, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = token_pair(*models.value)
        memory = both.memory
        run, n_docs, held, n_held, id_kind = TaskContext.get().partitionId() << 32, 0, [], 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            for part, pairs, documents in runs_of(np.concatenate(held), radix):
                yield batch_of(id_kind, 1, run=[run], part=[part], pairs=[pairs], documents=[documents])

        for batch in batches:
            id_kind = batch.schema.field("id").type
            ids = batch.column("id").to_pylist()
            for first, texts in text_batches(batch.column("text").to_pylist()):
                if n_docs + len(texts) > RUN_DOCUMENTS or n_held >= RUN_RECORDS:
                    yield from flush()
                    run, n_docs, held, n_held = run + RUN_DOCUMENTS, 0, [], 0
                memory.shrink()
                numbers = [memory.numbers(spaced_chunks(t)) if t else [] for t in texts]
                flat = np.fromiter(chain.from_iterable(numbers), np.int64)
                memory.learn(flat)
                good, n_a, n_b, n_groups, spelled, pairs = memory.columns or ([],) * 6
                out = {k: [] for k in names[2:7]}
                for k, codes in enumerate(numbers):
                    fine = bool(codes) and all(map(good.__getitem__, codes))
                    at = codes if fine else []
                    a, b, g = (sum(map(column.__getitem__, at)) for column in (n_a, n_b, n_groups))
                    digest = hashlib.sha256(";".join(map(spelled.__getitem__, at)).encode()).hexdigest() if fine else ""
                    for name, value in zip(names[2:7], (a, b, g, a + b - g, digest), strict=True):
                        out[name].append(value)
                    if fine:
                        held.append(np.frombuffer(b"".join(map(pairs.__getitem__, at)), np.uint64) | np.uint64(n_docs + k << LINK_BITS | 1))
                        n_held += len(held[-1])
                yield batch_of(id_kind, len(texts), id=ids[first : first + len(texts)], key=[run + n_docs + k for k in range(len(texts))], **out)
                n_docs += len(texts)
        if held:
            yield from flush()

    return d.mapInArrow(rows, f"id {kind}, key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, run long, part int, pairs binary, documents binary")


def merged(runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """B ids, A ids and counts of sorted runs, merged: a heap holds the next B id
    of each run, and the entries of one B id in all runs are summed together."""
    heads, out = [], []
    for r, (b, _, _) in enumerate(runs):
        stops = np.append(np.flatnonzero(np.diff(b)) + 1, len(b)).tolist()
        heads.append((iter(stops), 0))
        if len(b):
            stop = next(heads[r][0])
            out.append((int(b[0]), r, 0, stop))
    heap, found = out, []
    heapq.heapify(heap)
    while heap:
        side, taken = heap[0][0], []
        while heap and heap[0][0] == side:
            _, r, s, e = heap[0]
            taken.append((runs[r][1][s:e], runs[r][2][s:e]))
            stop = next(heads[r][0], None)
            if stop is None:
                heapq.heappop(heap)
            else:
                heapq.heapreplace(heap, (int(runs[r][0][e]), r, e, stop))
        if len(taken) == 1:
            others, counts = taken[0]
        else:
            others, back = np.unique(np.concatenate([x for x, _ in taken]), return_inverse=True)
            counts = np.zeros(len(others), np.int64)
            np.add.at(counts, back, np.concatenate([x for _, x in taken]))
        found.append((np.full(len(others), side), others, counts))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3


def count_pairs(runs: DataFrame) -> DataFrame:
    """Per radix partition: ``pairs``, B id, A id, count, and whether it is
    the highest of its B id."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting = None, []

        def done() -> pa.RecordBatch:
            b, a, n = merged(waiting)
            first = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
            best = np.repeat(np.maximum.reduceat(n, first), np.diff(np.append(first, len(b)))) == n
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([packed(b, a, n, best)], pa.binary())], ["part", "pairs"])

        for batch in batches:
            for part, block in zip(batch.column("part").to_pylist(), batch.column("pairs"), strict=True):
                if part != now:
                    if waiting:
                        yield done()
                    now, waiting = part, []
                b, a, _, n = unpacked(block.as_py())
                waiting.append((b, a, n))
                if len(waiting) == FAN_IN:
                    waiting = [merged(waiting)]
        if waiting:
            yield done()

    return runs.select("part", "pairs").repartition("part").sortWithinPartitions("part").mapInArrow(count, "part int, pairs binary")


def contributions(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """``key``, ``count_sum`` and ``n_best`` of what each run gives its documents,
    summed as far as a task holds a document."""
    # One row for each radix partition: their number is fixed.
    sizes = F.broadcast(runs.groupBy("part").agg(F.ceil(F.sum(F.length("documents") + F.length("pairs")) / TASK_BYTES).cast("long").alias("shares")))
    shares = F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)
    first = counts.join(sizes, "part").select("part", F.explode(shares).alias("share"), F.lit(None).cast("long").alias("run"), "pairs", F.lit(None).cast("binary").alias("documents"))
    rest = runs.join(sizes, "part").select("part", F.pmod(F.xxhash64("run"), F.col("shares")).alias("share"), "run", "pairs", "documents")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = count = best = None
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        n_held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for run, (sums, bests) in held.items():
                at = np.flatnonzero(sums)
                yield pa.RecordBatch.from_arrays([pa.array(run + at), pa.array(sums[at]), pa.array(bests[at])], ["key", "count_sum", "n_best"])

        for batch in batches:
            for run, pairs, documents in zip(batch.column("run").to_pylist(), batch.column("pairs"), batch.column("documents"), strict=True):
                b, a, n, links = unpacked(pairs.as_py())
                if run is None:  # the counts of a radix partition come before its runs
                    known, count, best = b << ID_BITS | a, n, links
                    continue
                at = np.repeat(np.searchsorted(known, b << ID_BITS | a), n)
                step, links = unpacked(documents.as_py())
                doc = np.cumsum(step) & DOC_MASK
                sums, bests = held.get(run, (np.zeros(0, np.int64),) * 2)
                more = int(doc.max()) + 1 - len(sums)
                if more > 0:
                    sums, bests = (np.concatenate([x, np.zeros(more, np.int64)]) for x in (sums, bests))
                    held[run], n_held = (sums, bests), n_held + more
                np.add.at(sums, doc, links * count[at])
                np.add.at(bests, doc, links * best[at])
                if n_held > HELD_DOCUMENTS:
                    yield from flush()
                    held, n_held = {}, 0
        yield from flush()

    dealt = first.union(rest).repartition("part", "share").sortWithinPartitions("part", "share", F.col("run").asc_nulls_first())
    return dealt.select("run", "pairs", "documents").mapInArrow(stream, "key long, count_sum long, n_best long")


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", radix: int = RADIX) -> DataFrame:
    """Per row: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``,
    ``count_sum``, ``groups_sha256``.

    ``path_a`` is a byte-level vocabulary of the tokenizers library, ``path_b`` a
    sentencepiece model. Both files (under two megabytes) are read on the driver
    and broadcast."""
    models = []
    for path in (path_a, path_b):
        with open(path, "rb") as f:
            models.append(f.read())
    encoded = materialize(encode_documents(docs, *models, id_col, text_col, radix), "token-runs")
    runs = encoded.where("part IS NOT NULL").select("run", "part", "pairs", "documents")
    counts = materialize(count_pairs(runs), "pair-counts")
    sums = contributions(runs, counts).groupBy("key").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    texts = encoded.where("key IS NOT NULL")
    out = texts.join(sums, "key", "left").na.fill(0, ["count_sum", "n_best"])
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
