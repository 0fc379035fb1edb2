"""Words of whole Arrow batches as numpy arrays, and hashes of runs of words.

A word is a run of bytes other than ASCII white space (20, 09-0D). Hashes are
sums of products modulo 2**64, so that one cumulative sum gives the hash of
every window; a final mix spreads them over all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # text worked on at a time (one document at least)

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rng.integers(1, 2**61)) * 8 + 3
_STEP = int(_rng.integers(1, 2**61)) * 8 + 3


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all their bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    """``base**0 .. base**(n-1)`` modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (n + 1) and bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return at - at[0], np.zeros(0, np.uint8)
    return at - at[0], np.frombuffer(data, np.uint8)[at[0]:at[-1]]


@dataclass
class Words:
    """Words of consecutive documents: ``first[i]:first[i + 1]`` are those of ``i``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @classmethod
    def split(cls, offsets: np.ndarray, data: np.ndarray, space=SPACE) -> Words:
        if not len(data):
            none = np.zeros(0, np.int64)
            return cls(data, none, none, np.zeros(len(offsets), np.int64))
        inside = ~space[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        before = np.empty(len(data), dtype=bool)
        before[0], before[1:] = True, ~inside[:-1]
        after = np.empty(len(data), dtype=bool)
        after[-1], after[:-1] = True, ~inside[1:]
        start = np.flatnonzero(inside & (before | edge[:-1]))
        end = np.flatnonzero(inside & (after | edge[1:])) + 1
        return cls(data, start, end, np.searchsorted(start, offsets))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        length = self.end - self.start
        # Bytes between words belong to no word: give them weight zero.
        lead = int(self.start[0])
        gap = np.append(self.start[1:], len(self.data)) - self.start
        place = np.arange(len(self.data) - lead) - np.repeat(self.start - lead, gap)
        values = _BYTE[self.data[lead:]] * powers(_BASE, int(gap.max()))[place]
        values[place >= np.repeat(length, gap)] = 0
        return mix(np.add.reduceat(values, self.start - lead) + length.astype(np.uint64))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive word hashes (across documents too)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * powers(_STEP, len(words)), out=total[1:])
    back = powers(pow(_STEP, -1, 1 << 64), n)
    return mix((total[size:] - total[:-size]) * back + np.uint64(size))


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Whether a window of ``size`` words that starts at each word stays in its document."""
    inside = np.ones(int(first[-1]), dtype=bool)
    tail = np.minimum(size - 1, np.diff(first))
    ends = np.repeat(first[1:], tail)
    back = np.arange(len(ends)) - np.repeat(np.cumsum(tail) - tail, tail)
    inside[ends - 1 - back] = False
    return inside


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of documents of about ``limit`` bytes, one document at least."""
    at, n = 0, len(offsets) - 1
    while at < n:
        stop = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        stop = min(max(stop, at + 1), n)
        yield at, stop
        at = stop
