"""Packing documents into sequences of a fixed number of tokens: bounded-space
online best-fit.

A document is its token ids and an end id. Only a document longer than a
sequence is cut, into full pieces and a rest. Each task packs the pieces it
meets: a fixed number of sequences is open, found by their free space in a bitset;
a piece goes to the fullest open sequence that has room, or else opens a new one,
and if too many are open the fullest closes first. What is still open when a task
ends is packed once more: these pieces are dealt to few tasks by hash, longest
first, by the same method, so the loss does not grow with the number of tasks.

Chunks of text between white spaces are encoded independently by the tokenizers
library, words of Latin letters without its normaliser; a bounded memory holds the
ids of chunks met before.

Cases: null and empty texts, and texts without a token, are the end id alone;
repeated rows are packed each; a row with a null id is packed like any other;
an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.chunks import ChunkMemory, text_batches
from voltide.session import materialize

SEQUENCE_TOKENS = 4096
END_ID = 1
OPEN_SEQUENCES = 256
#: Open sequences of a task with more free space than this are packed again.
WASTE = 16
#: Sequences' worth of such pieces that one task packs.
REST_SEQUENCES = 1_024
#: A word that stands between two chunks when many are encoded in one call.
MARK = "\x00"
#: White space to Python, but not to the tokenizer.
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Chunks that a worker remembers.
MEMORY_CHUNKS = 800_000
#: Latin letters with one code each, and punctuation after them.
_PLAIN = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,;:!?]*)")


class BestFit:
    """At most ``most_open`` bins of ``size``. ``add`` returns the bins that it
    closes, each a list of (offset, item)."""

    def __init__(self, size: int = SEQUENCE_TOKENS, most_open: int = OPEN_SEQUENCES):
        self.size, self.most_open, self.n_open = size, most_open, 0
        #: Bit f is set where an open bin has f free; such bins are in by_free[f].
        self.bits = 0
        self.by_free: list[list[list[tuple[int, object]]]] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> list[tuple[int, object]]:
        bins = self.by_free[free]
        out = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.n_open -= 1
        return out

    def _put(self, free: int, content: list[tuple[int, object]]) -> None:
        self.by_free[free].append(content)
        self.bits |= 1 << free
        self.n_open += 1

    def add(self, length: int, item: object) -> list[list[tuple[int, object]]]:
        if not 0 < length <= self.size:
            raise ValueError(f"an item of {length} does not fit a bin of {self.size}")
        room, closed = self.bits >> length, []
        if room:
            free = length + (room & -room).bit_length() - 1
            content = self._take(free)
        else:
            free, content = self.size, []
        content.append((self.size - free, item))
        if free == length:
            closed.append(content)
        else:
            if self.n_open == self.most_open:
                closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            self._put(free - length, content)
        return closed

    def rest(self) -> Iterator[tuple[int, list[tuple[int, object]]]]:
        """Free space and content of the open bins, fullest first; they leave."""
        while self.bits:
            free = (self.bits & -self.bits).bit_length() - 1
            yield free, self._take(free)


class WordEncoder:
    """Token ids of chunks between white spaces, as little-endian bytes."""

    def __init__(self, model: bytes):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_buffer(model)
        # Small Latin letters are normal already and one word to the pattern.
        self.plain = Tokenizer.from_buffer(model)
        self.plain.normalizer = None
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        alone = self._ids(self.tokenizer, [MARK])[0]
        self.mark = alone[0] if len(alone) == 1 and self._ids(self.tokenizer, [f"a {MARK} b"])[0].count(alone[0]) == 1 else None
        self.memory = ChunkMemory(self.encode, MEMORY_CHUNKS)
        self.tails: dict[str, bytes] = {"": b""}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    @staticmethod
    def _ids(tokenizer, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, tokenizer, words: list[str], mark: int, between: str) -> list[bytes]:
        """The ids of words, many to a call with a mark between each two."""
        out: list[bytes] = []
        for at in range(0, len(words), 512):
            group = words[at : at + 512]
            ids = np.array(self._ids(tokenizer, [f" {between} ".join(group)])[0], "<u4")
            cuts = np.flatnonzero(ids == mark)
            if len(cuts) != len(group) - 1:
                raise ValueError("chunks that were encoded together cannot be told apart")
            raw = ids.tobytes()
            out += [raw[a:b] for a, b in zip([0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(raw)], strict=True)]
        return out

    def encode(self, keys: list[str]) -> tuple[list[bytes]]:
        # Punctuation after a word is a token sequence of its own.
        split = [(m[1].lower(), m[2]) if (m := _PLAIN.fullmatch(k)) else None for k in keys]
        known: dict[str, bytes] = {}
        for tail in {m[1] for m in split if m} - self.tails.keys():
            self.tails[tail] = np.array(self._ids(self.tokenizer, [tail])[0], "<u4").tobytes()
        if self.memory.columns:
            ids, learned = self.memory.columns[0], self.memory.learned
            for m in split:
                if m and (code := self.memory.get(m[0], learned)) < learned:
                    known[m[0]] = ids[code]
        stems = list({m[0]: None for m in split if m and m[0] not in known})
        # A number is never a token of a word of letters.
        digit = self._ids(self.tokenizer, ["0"])[0]
        if len(digit) == 1 and self._ids(self.plain, ["0"])[0] == digit:
            known.update(zip(stems, self._together(self.plain, stems, digit[0], "0"), strict=True))
        else:
            known.update((k, np.array(ids, "<u4").tobytes()) for k, ids in zip(stems, self._ids(self.tokenizer, stems), strict=True))
        others = [k for k, m in zip(keys, split, strict=True) if not m]
        marked = [k for k in others if self.mark is not None and MARK not in k]
        found = dict(zip(marked, self._together(self.tokenizer, marked, self.mark, MARK), strict=True))
        alone = [k for k in others if k not in found]
        if alone:
            found.update((k, np.array(ids, "<u4").tobytes()) for k, ids in zip(alone, self._ids(self.tokenizer, alone), strict=True))
        return ([known[m[0]] + self.tails[m[1]] if m else found[k] for k, m in zip(keys, split, strict=True)],)

    def texts(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text."""
        memory = self.memory
        memory.shrink()
        numbers = [memory.numbers(self._chunks(t)) for t in texts]
        memory.learn(np.fromiter(chain.from_iterable(numbers), np.int64))
        ids = memory.columns[0] if memory.columns else []
        for codes in numbers:
            yield b"".join(map(ids.__getitem__, codes))

    def _chunks(self, text: str) -> list[str]:
        if any(c in text for c in SEPARATORS):
            return [text]
        # Outside ASCII the tokenizer has its own small letters; special tokens are
        # found before there are any.
        low = text.lower() if text.isascii() else text
        return (text if any(t in low for t in self.special) else low).split()


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(model: bytes) -> WordEncoder:
    """One encoder for a worker and model."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(model)
    return _ENCODERS[key]


def cut(ids: bytes, size: int) -> list[tuple[int, int, int, int]]:
    """Piece number, start, length and CRC-32 of the pieces of a document."""
    step = 4 * size
    return [(k, at // 4, min(step, len(ids) - at) // 4, zlib.crc32(ids[at : at + step])) for k, at in enumerate(range(0, len(ids), step))]


class Placed:
    """Collects placed pieces and writes them as Arrow batches."""

    def __init__(self, kind: pa.DataType):
        self.kind, self.rows, self.next = kind, [], TaskContext.get().partitionId() << 32

    def close(self, content: list[tuple[int, tuple]], final: bool = True) -> None:
        if final:
            self.rows += [(*item, self.next, offset) for offset, item in content]
            self.next += 1
        else:
            self.rows += [(*item, None, None) for _, item in content]

    def batches(self, least: int) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            columns = zip(*self.rows, strict=True) if self.rows else ([],) * 7
            kinds = [self.kind, pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds, strict=True)], ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
            self.rows = []


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", size: int = SEQUENCE_TOKENS, end_id: int = END_ID, most_open: int = OPEN_SEQUENCES
) -> DataFrame:
    """Per piece: id, ``piece``, ``start``, ``length``, ``ids_crc32`` (of its ids
    as little-endian 32-bit numbers), ``sequence_id`` and ``offset``.

    The tokenizer file (under two megabytes) is read on the driver and broadcast."""
    with open(tokenizer_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer, out = encoder(model.value), BestFit(size, most_open), None
        for batch in batches:
            out = out or Placed(batch.schema.field("id").type)
            ids = batch.column("id").to_pylist()
            for first, texts in text_batches(batch.column("text").to_pylist()):
                for k, own in enumerate(words.texts(texts), first):
                    for piece in cut(own + end, size):
                        for content in packer.add(piece[2], (ids[k], *piece)):
                            out.close(content)
                yield from out.batches(10_000)
        if out:
            for free, content in packer.rest():
                out.close(content, free <= WASTE)
            yield from out.batches(1)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, out = BestFit(size, most_open), None
        for batch in batches:
            out = out or Placed(batch.schema.field("id").type)
            for row in zip(*(c.to_pylist() for c in batch.columns[:5]), strict=True):
                for content in packer.add(row[3], row):
                    out.close(content)
            yield from out.batches(10_000)
        if out:
            for _, content in packer.rest():
                out.close(content)
            yield from out.batches(1)

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {d.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    placed = materialize(d.mapInArrow(tokens, schema), "packed")
    rest = placed.where("sequence_id IS NULL")
    total = rest.agg(F.sum("length")).first()[0] or 0
    parts = -(-total // (size * REST_SEQUENCES)) or 1
    packed = rest.repartition(parts, F.xxhash64("id", "piece", "start", "ids_crc32")).sortWithinPartitions(F.desc("length"), "id", "piece", "ids_crc32").mapInArrow(again, schema)
    # Numbers of the first packing are not negative.
    packed = packed.withColumn("sequence_id", -1 - F.col("sequence_id"))
    return placed.where("sequence_id IS NOT NULL").union(packed).withColumnRenamed("id", id_col)
