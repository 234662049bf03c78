"""Vectorised word splitting and hashing over Arrow text batches.

Operators that compare word sequences across documents never need the words themselves, only equality, so
each word becomes a 64-bit hash computed with numpy straight on the UTF-8 bytes of an Arrow batch: no Python
object per word.  Batches are cut into slices of bounded bytes, so memory follows the slice, not the batch;
one very long document forms a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: UTF-8 bytes of text handled at once; a longer document is a slice of its own.
SLICE_BYTES = 1 << 19

_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _spaces(lower: bool) -> np.ndarray:
    """Byte table of the words ``[^\\x20\\x09-\\x0D]+``: 0 is a separator, any other value stands for the byte."""
    t = np.arange(1, 257, dtype=np.uint16)
    t[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0
    if lower:
        t[0x41:0x5B] = t[0x61:0x7B]
    return t


def _alnum() -> np.ndarray:
    """Byte table of the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    t = np.zeros(256, dtype=np.uint16)
    for lo, hi in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
        t[lo:hi] = np.arange(lo + 1, hi + 1)
    t[0x41:0x5B] = t[0x61:0x7B]
    return t


SPACED, SPACED_LOWER, ALNUM_LOWER = _spaces(False), _spaces(True), _alnum()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    p = np.empty(max(n, 1), dtype=np.uint64)
    p[0] = 1
    if n > 1:
        p[1:] = _BASE
        np.multiply.accumulate(p, out=p)
    return p


class Words:
    """The words of some documents: ``h`` hashes, ``first`` index of each document's first word (one more at
    the end), ``start`` and ``end`` byte positions in ``data``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, table: np.ndarray):
        self.data, self.bounds = data, bounds
        v = table[data]
        word = v > 0
        if len(data):
            begins = word.copy()
            begins[1:] &= ~word[:-1]
            heads = bounds[:-1][bounds[:-1] < bounds[1:]]
            begins[heads] = word[heads]
            ends = word.copy()
            ends[:-1] &= ~word[1:]
            tails = heads_end = bounds[1:][bounds[:-1] < bounds[1:]] - 1
            ends[tails] = word[heads_end]
            self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        else:
            self.start = self.end = np.zeros(0, dtype=np.int64)
        self.first = np.searchsorted(self.start, bounds)
        if len(self.start):
            size = self.end - self.start
            chars = v[word].astype(np.uint64)
            at = np.zeros(len(self.start), dtype=np.int64)
            np.cumsum(size[:-1], out=at[1:])
            place = np.arange(len(chars)) - np.repeat(at, size)
            chars *= _powers(int(size.max()))[place]
            self.h = mix(np.add.reduceat(chars, at) + size.astype(np.uint64) * _MULT)
        else:
            self.h = np.zeros(0, dtype=np.uint64)

    def __len__(self) -> int:
        return len(self.h)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of k words inside one document, and each run's first word."""
        n = self.counts - (k - 1)
        n[n < 0] = 0
        total = int(n.sum())
        if not total:
            return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        out = np.zeros(len(self.h) - k + 1, dtype=np.uint64)
        m = np.uint64(1)
        for j in range(k):
            m = np.uint64((int(m) * int(_MULT) + 2 * j + 1) & 0xFFFFFFFFFFFFFFFF | 1)
            out += self.h[j : len(self.h) - k + 1 + j] * m
        begin = np.zeros(len(n), dtype=np.int64)
        np.cumsum(n[:-1], out=begin[1:])
        at = np.arange(total) - np.repeat(begin - self.first[:-1], n)
        return mix(out[at]), at


def text_slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, document bounds in them) for slices of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offs, data = column.buffers()
    n = len(column)
    offs = np.frombuffer(offs, dtype=np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        j = min(j, n)
        yield i, j, raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j
