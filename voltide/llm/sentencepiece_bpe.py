"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps a score-ordered agenda of adjacent symbol pairs whose
concatenation is a piece: the best pair (ties: the leftmost) is merged and its
new neighbours join the agenda. Symbols that are no piece fall back to bytes.

A text is first cut where no piece can span: before a word and the spaces or line
feeds that precede it (the vocabulary is searched for pieces that do; if there are
any, texts stay whole). Merges never cross a cut, so parts are encoded independently,
and ids of parts met before come from a bounded memory. Each new part is checked against
the sentencepiece library, one library call for each Arrow batch; a difference
raises.

Cases: null and empty texts have no ids and decode to an empty text; literal
U+2581 counts as a space, as in the library; repeated rows are encoded each.
Only id and text are read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltide.llm.chunks import ChunkMemory, chunk_text, spaced_chunks, text_batches

SPACE = "▁"
#: Parts that a worker remembers.
MEMORY_PARTS = 600_000
#: Symbols up to which a part's agenda is a list.
SHORT = 48
#: The rank of a pair that is no piece.
NEVER = float("inf")


def spelled_bytes(raw: bytes) -> str:
    """UTF-8 text; each byte that belongs to no character gives one U+FFFD."""
    out = []
    while raw:
        try:
            out.append(raw.decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[: e.start].decode() + "\ufffd")
            raw = raw[e.start + 1 :]
    return "".join(out)


class PieceVocabulary:
    """Pieces of a merge-type model, its agenda encoder and its decoder."""

    def __init__(self, model: bytes):
        self.library = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        probe = "  a  ﬁ ▁ Ａ\t b "
        if sp.normalize(probe) != self.marked(probe):
            raise ValueError("only models without text normalisation are supported")
        n = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) for i in range(n)]
        if any(sp.is_unused(i) for i in range(n)):
            raise ValueError("models with unused pieces are not supported")
        self.names = names
        self.byte_of = {i: int(names[i][3:5], 16) for i in range(n) if sp.is_byte(i)}
        self.byte_ids = {b: i for i, b in self.byte_of.items()}
        self.special = {i for i in range(n) if special[i]}
        self.ids = {p: i for i, p in enumerate(names) if not special[i] and i not in self.byte_of}
        self.plain = set(self.ids.values())
        self.rank = {p: -sp.get_score(i) for p, i in self.ids.items()}
        self.whole = self._spans_words()
        self.memory = ChunkMemory(self.learn, MEMORY_PARTS)

    @staticmethod
    def marked(text: str) -> str:
        return SPACE + text.replace(" ", SPACE) if text else ""

    def _spans_words(self) -> bool:
        """Whether a piece holds a line feed, or a space mark after anything else."""
        pairs = {p[k : k + 2] for p in self.ids for k in range(len(p) - 1)}
        return any("\n" in x or (x[1] == SPACE and x[0] != SPACE) for x in pairs)

    def merge_short(self, part: str) -> list[str]:
        """As ``merge``, with the agenda as a plain list by place: the least of
        a few ranks is found sooner than a heap is kept in order."""
        get, symbols = self.rank.get, list(part)
        agenda = [get(a + b, NEVER) for a, b in zip(symbols, symbols[1:], strict=False)]
        while agenda and (best := min(agenda)) != NEVER:
            k = agenda.index(best)
            both = symbols[k] + symbols.pop(k + 1)
            symbols[k] = both
            del agenda[k]
            if k:
                agenda[k - 1] = get(symbols[k - 1] + both, NEVER)
            if k < len(agenda):
                agenda[k] = get(both + symbols[k + 1], NEVER)
        return symbols

    def merge(self, part: str) -> list[str]:
        """The pieces of a part, by the agenda."""
        if len(part) <= SHORT:
            return self.merge_short(part)
        symbols: list[str | None] = list(part)
        n, rank = len(symbols), self.rank
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        agenda = [(r, k, both) for k in range(n - 1) if (r := rank.get(both := part[k : k + 2])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, k, both = heapq.heappop(agenda)
            a = symbols[k]
            if a is None or (j := right[k]) >= n or len(a) + len(symbols[j]) != len(both):
                continue  # one of the two has been merged since
            symbols[k], symbols[j] = both, None
            right[k] = after = right[j]
            if after < n:
                left[after] = k
                pair = both + symbols[after]
                if (r := rank.get(pair)) is not None:
                    heapq.heappush(agenda, (r, k, pair))
            if (before := left[k]) >= 0:
                pair = symbols[before] + both
                if (r := rank.get(pair)) is not None:
                    heapq.heappush(agenda, (r, before, pair))
        return [s for s in symbols if s is not None]

    def part_ids(self, part: str) -> list[int]:
        ids, pieces = self.ids, self.merge(part)
        try:
            return [ids[s] for s in pieces]
        except KeyError:
            pass
        out = []
        for s in pieces:
            if s in ids:
                out.append(ids[s])
            else:
                out.extend(self.byte_ids[b] for b in s.encode())
        return out

    def encode(self, text: str) -> list[int]:
        return [i for k in self.cut(text) for i in self.part_ids(chunk_text(k).replace(" ", SPACE))]

    def _spelled(self, ids: list[int]) -> str:
        if self.plain.issuperset(ids):
            return "".join([self.names[i] for i in ids]).replace(SPACE, " ")
        out, raw = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(spelled_bytes(bytes(raw)))
                raw.clear()
            if i not in self.special:
                out.append(self.names[i])
        if raw:
            out.append(spelled_bytes(bytes(raw)))
        return "".join(out).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        text = self._spelled(ids)
        first = next((i for i in ids if i not in self.special), None)
        return text if first in self.byte_of else text.removeprefix(" ")

    def cut(self, text: str) -> list[str]:
        """The keys of the parts of a text."""
        if not text:
            return []
        text = text.replace(SPACE, " ")
        return [f" {text}" if text[0] in " \n" else text] if self.whole else spaced_chunks(text)

    def learn(self, keys: list[str]) -> tuple[list[str], list[str]]:
        """The ids of parts, as text, and what they decode to."""
        found = {k: self.part_ids(chunk_text(k).replace(" ", SPACE)) for k in keys}
        self._check(found)
        return [",".join(map(str, ids)) for ids in found.values()], [self._spelled(ids) for ids in found.values()]

    def encoded(self, texts: list[str]) -> Iterator[tuple[str, str]]:
        """For each text its ids, comma-joined, and the decoded text."""
        memory = self.memory
        memory.shrink()
        numbers = [memory.numbers(self.cut(t)) for t in texts]
        memory.learn(np.fromiter(chain.from_iterable(numbers), np.int64))
        ids, spelled = memory.columns or ([], [])
        for codes in numbers:
            yield ",".join(map(ids.__getitem__, codes)), "".join(map(spelled.__getitem__, codes)).removeprefix(" ")

    def _check(self, found: dict[str, list[int]]) -> None:
        """Compares parts with the library. It sets a space mark before every
        text; a line feed, which no piece spans, keeps mark and part apart."""
        lead = [] if self.whole else self.library.encode("\n")
        texts = [chunk_text(k)[1:] if self.whole else "\n" + chunk_text(k) for k in found]
        for (k, ids), have in zip(found.items(), self.library.encode(texts, num_threads=1), strict=True):
            if lead + ids != have:
                raise ValueError(f"part {chunk_text(k)!r}: {ids} differs from the library's {have[len(lead) :]}")


_VOCABULARIES: dict[str, PieceVocabulary] = {}


def vocabulary(model: bytes) -> PieceVocabulary:
    """One vocabulary per worker and model."""
    key = hashlib.sha256(model).hexdigest()
    if key not in _VOCABULARIES:
        _VOCABULARIES[key] = PieceVocabulary(model)
    return _VOCABULARIES[key]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: id, ``n_tokens``, SHA-256 of the comma-joined ids and of the
    decoded text; with ``with_ids`` also ``ids`` and ``decoded``.

    The model file (under a megabyte) is read on the driver and broadcast."""
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model.value)
        for whole in batches:
            for first, texts in text_batches(whole.column("text").to_pylist()):
                batch = whole.slice(first, len(texts))
                count, ids_hash, text_hash, ids_out, decoded_out = [], [], [], [], []
                for ids, decoded in vocab.encoded(texts):
                    count.append(ids.count(",") + 1 if ids else 0)
                    ids_hash.append(hashlib.sha256(ids.encode()).hexdigest())
                    text_hash.append(hashlib.sha256(decoded.encode()).hexdigest())
                    if with_ids:
                        ids_out.append([int(i) for i in ids.split(",")] if ids else [])
                        decoded_out.append(decoded)
                columns = [batch.column("id"), pa.array(count, pa.int64()), pa.array(ids_hash), pa.array(text_hash)]
                names = ["id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    columns += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(decoded_out, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    more = ", ids array<int>, decoded string" if with_ids else ""
    kind = d.schema["id"].dataType.simpleString()
    return d.mapInArrow(rows, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}").withColumnRenamed("id", id_col)
