"""Texts as chunks that tokenizers encode independently of their neighbours, and
a bounded memory of what is known of each distinct chunk.

A chunk is a word with the white space before it (where that is more than spaces
and line feeds, several words may be one chunk). Its key leaves out a single
leading space, so the commonest chunks are plain words; every other key starts
with white space and is the chunk itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np

#: Unicode white space besides space and line feed.
RARE_SPACES = "\t\x0b\x0c\r\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_BLANK = f" \n{RARE_SPACES}"
_CHUNK = re.compile(f"[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+")
_ASCII_RARE = RARE_SPACES[:4]


def plainly_spaced(text: str) -> bool:
    """Whether each white space is one space or line feed between two words."""
    if "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[-1:] in (" ", "\n"):
        return False
    return not any(c in text for c in (_ASCII_RARE if text.isascii() else RARE_SPACES))


def spaced_chunks(text: str) -> list[str]:
    """The keys of the chunks of a space and ``text``. A chunk starts where a run
    of white space does, if that is with a space or a line feed."""
    if plainly_spaced(text) and text[:1] not in (" ", "\n"):
        return text.replace("\n", " \n").split(" ")
    keys: list[str] = []
    for found in _CHUNK.findall(" " + text):
        if found[0] in RARE_SPACES:
            keys[-1] += found
        else:
            keys.append(found)
    return [k[1:] if k[0] == " " and k[1:2] and k[1] not in _BLANK else k for k in keys]


def chunk_text(key: str) -> str:
    return key if key[0] in _BLANK else " " + key


class ChunkMemory(dict):
    """Numbers the distinct chunks that a worker meets: ``memory[key]`` is the
    number, and a key not met before is given the next one. ``learn`` hands the
    new keys to ``encode`` in one call and keeps its columns, one value a chunk.

    The memory is bounded: ``shrink`` keeps the chunks met most often since
    the last time, half of ``most`` at most. Numbers are valid until then."""

    def __init__(self, encode: Callable[[list[str]], tuple[list, ...]], most: int = 400_000):
        super().__init__()
        self.encode, self.most = encode, most
        self.names: list[str] = []
        self.columns: tuple[list, ...] = ()
        self.uses = np.zeros(0, np.int64)
        self.learned = 0

    def __missing__(self, key: str) -> int:
        self[key] = code = len(self.names)
        self.names.append(key)
        return code

    def numbers(self, keys: list[str]) -> list[int]:
        return list(map(self.__getitem__, keys))

    def learn(self, codes: np.ndarray) -> None:
        """Encodes the chunks that are new; ``codes`` are the numbers just given."""
        fresh = self.names[self.learned :]
        if fresh:
            found = self.encode(fresh)
            if not self.columns:
                self.columns = tuple([] for _ in found)
            for column, values in zip(self.columns, found, strict=True):
                column.extend(values)
            self.learned = len(self.names)
        uses = np.bincount(codes, minlength=len(self.names))
        uses[: len(self.uses)] += self.uses
        self.uses = uses

    def shrink(self) -> bool:
        if len(self.names) <= self.most:
            return False
        keep = np.flatnonzero(self.uses > 1)
        if len(keep) > self.most // 2:
            keep = np.sort(keep[np.argsort(-self.uses[keep], kind="stable")[: self.most // 2]])
        at = keep.tolist()
        self.names = [self.names[k] for k in at]
        self.columns = tuple([column[k] for k in at] for column in self.columns)
        self.clear()
        self.update(zip(self.names, range(len(at)), strict=True))
        self.uses, self.learned = np.zeros(len(at), np.int64), len(at)
        return True


def text_batches(texts: list[Any], size: int = 256, chars: int = 4 << 20) -> Iterator[tuple[int, list[str]]]:
    """First number and texts (null: empty) of small groups of texts."""
    group, total, first = [], 0, 0
    for k, text in enumerate(texts):
        if group and (len(group) == size or total + len(text or "") > chars):
            yield first, group
            group, total, first = [], 0, k
        group.append(text or "")
        total += len(group[-1])
    if group:
        yield first, group
