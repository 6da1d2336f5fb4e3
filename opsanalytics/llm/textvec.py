"""Vectorised text steps for use inside Spark tasks: Arrow string columns as byte
arrays, word bounds, and polynomial hashes of arbitrary spans."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes handled at once; a longer single text is handled alone.
SLICE = 1 << 20
U = np.uint64

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
# Everything in ASCII that is neither letter nor digit separates; bytes of other scripts are letters.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

ODD = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over runs of rows of about ``limit`` bytes; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    bufs = column.buffers()
    off = np.frombuffer(bufs[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def folded(column: pa.Array) -> pa.Array:
    """Lower case; null is empty."""
    return pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))


def words(data: np.ndarray, off: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of all words, and the word offsets of the texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = ~separators[data]
    fresh = np.zeros(n + 1, bool)
    fresh[off] = True
    head = inside.copy()
    head[1:] &= ~inside[:-1] | fresh[1:n]
    tail = inside.copy()
    tail[:-1] &= ~inside[1:] | fresh[1:n]
    starts, ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
    return starts, ends, np.searchsorted(starts, off)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 ... base**(n-1) modulo 2**64; tables for ordinary lengths are kept."""
    return _kept(base)[:n] if n <= 2 * SLICE else _powers(base, n)


@lru_cache(maxsize=4)
def _kept(base: int) -> np.ndarray:
    return _powers(base, 2 * SLICE)


def _powers(base: int, n: int) -> np.ndarray:
    b = 4096
    low = np.cumprod(np.concatenate([np.ones(1, U), np.full(b - 1, base, U)]))
    high = np.cumprod(np.concatenate([np.ones(1, U), np.full(n // b, pow(base, b, 2**64), U)]))
    return np.multiply.outer(high, low).ravel()[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(32))) * U(0xD6E8FEB86659FD93)
    h = (h ^ (h >> U(29))) * U(0xBF58476D1CE4E5B9)
    return h ^ (h >> U(32))


class Spans:
    """Hashes of spans of a unit array; equal content gives equal hashes wherever it stands."""

    def __init__(self, units: np.ndarray, which: int = 0):
        n = len(units)
        base = ODD[which]
        self.sums = np.zeros(n + 1, U)
        term = units.astype(U)
        term += U(1)
        term *= powers(base, n)
        np.cumsum(term, out=self.sums[1:])
        self.back = powers(pow(base, -1, 2**64), n + 1)

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix((self.sums[hi] - self.sums[lo]) * self.back[lo] + (hi - lo).astype(U))

    def grams(self, g: int) -> np.ndarray:
        """Hash of every run of ``g`` units."""
        m = len(self.sums) - g
        if m <= 0:
            return np.zeros(0, U)
        return mix((self.sums[g:] - self.sums[:m]) * self.back[:m] + U(g))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return Spans(data)(starts, ends)


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values (block prefix and suffix minima)."""
    n = len(a)
    if n < w:
        return a[:0]
    pad = -n % w
    top = np.iinfo(a.dtype).max
    blocks = np.concatenate([a, np.full(pad, top, a.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - w + 1], ahead[w - 1:n])


def distinct(a: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting (quicker here than hashing)."""
    a = np.sort(a)
    new = np.ones(len(a), bool)
    new[1:] = a[1:] != a[:-1]
    return a[new]
