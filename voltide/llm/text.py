"""Words and word hashes of whole Arrow string columns, in numpy.

Texts stay UTF-8 bytes: all word classes used here are decided by single bytes
(every byte of a character outside ASCII is 0x80 or more), so no decoding is
needed. Work arrays cover about a megabyte of text at a time, whatever the
length of a text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

#: Words are runs of anything but space and the control characters 9 to 13.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[32, *range(9, 14)]] = False
#: Words are runs of digits, letters and anything outside ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_LOWER = np.arange(256)
_LOWER[65:91] += 32

U64 = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all others (in place)."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h ^= h >> U64(shift)
        h *= U64(factor)
    h ^= h >> U64(33)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_BYTE_VALUE_LOWER = _BYTE_VALUE[_LOWER]
_BASE = 0x5851F42D4C957F2D
_UP = _powers(_BASE, BLOCK_BYTES + 1)
_DOWN = _powers(pow(_BASE, -1, 1 << 64), BLOCK_BYTES + 1)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and its n + 1 row offsets (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the n + 1 word offsets of the rows."""
    inside = word_bytes[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    before[edge], after[edge - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash for each word; with ``lower``, A-Z count as a-z."""
    value = _BYTE_VALUE_LOWER if lower else _BYTE_VALUE
    out = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        low = starts[at]
        stop = max(at + 1, int(np.searchsorted(ends, low + BLOCK_BYTES, "right")))
        high = ends[stop - 1]
        size = int(high - low)
        if size <= BLOCK_BYTES:
            sums = np.zeros(size + 1, U64)
            np.cumsum(value[data[low:high]] * _UP[:size], out=sums[1:])
            s, e = starts[at:stop] - low, ends[at:stop] - low
            out[at:stop] = (sums[e] - sums[s]) * _DOWN[s]
        else:  # one word longer than a block: fold it block by block
            total = U64(0)
            with np.errstate(over="ignore"):
                for k in range(int(low), int(high), BLOCK_BYTES):
                    part = data[k : min(k + BLOCK_BYTES, int(high))]
                    total = total * _UP[BLOCK_BYTES] + (value[part] * _UP[: len(part)]).sum(dtype=U64)
            out[at] = total
        at = stop
    out += (ends - starts).astype(U64)
    return mix(out)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words (fewer words: the whole run, none: nothing)."""
    if not len(words):
        return np.zeros(0, U64)
    size = min(size, len(words))
    n = len(words) - size + 1
    out = np.full(n, size, U64)
    for k in range(size):
        out *= U64(0xD6E8FEB86659FD93)
        out += words[k : k + n]
    return mix(out)


def row_ranges(offsets: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Runs of rows of at most ``limit`` bytes each (a longer row stands alone)."""
    out, at, n = [], 0, len(offsets) - 1
    while at < n:
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        out.append((at, min(stop, n)))
        at = stop
    return out
