"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A word is a run of bytes other than space and tab..carriage return; in UTF-8
that equals the run of code points, as those bytes never occur inside a longer
sequence. Words get a 64-bit polynomial hash, computed for all words of a
block from one running sum, so no Python object per word is ever made.
Memory: texts are cut into blocks of whole rows (``BLOCK_BYTES``); inside a
block, and inside one very long text, hashing goes on by pieces of whole words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 2 << 20
PIECE_BYTES = 1 << 18
U64 = np.uint64
#: Odd multiplier of the polynomial and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_values(lower: bool) -> np.ndarray:
    """A random 64-bit value per byte; with ``lower``, A-Z share those of a-z."""
    values = mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95))
    if lower:
        values[65:91] = values[97:123]
    return values


def powers(n: int, base: int) -> np.ndarray:
    out = np.full(n + 1, base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hasher:
    """Hashes byte ranges of a buffer; keeps its power tables."""

    def __init__(self, lower: bool = False):
        self.values = byte_values(lower)
        self.size = 0
        self.grow(PIECE_BYTES)

    def grow(self, n: int) -> None:
        if n > self.size:
            self.power, self.inverse, self.size = powers(n, BASE), powers(n, BASE_INVERSE), n

    def ranges(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each ``data[start:end]``; starts rise and ranges don't overlap.
        The length goes in, so that a range and the same with zero bytes differ."""
        out = np.empty(len(start), U64)
        i = 0
        while i < len(start):
            limit = int(start[i]) + PIECE_BYTES
            j = max(i + 1, int(np.searchsorted(end, limit, "right")))
            lo, hi = int(start[i]), int(end[j - 1])
            self.grow(hi - lo)
            total = np.zeros(hi - lo + 1, U64)
            np.cumsum(self.values[data[lo:hi]] * self.power[: hi - lo], out=total[1:])
            s, e = start[i:j] - lo, end[i:j] - lo
            out[i:j] = (total[e] - total[s]) * self.inverse[s] + (e - s).astype(U64)
            i = j
        return mix(out)


class Texts(NamedTuple):
    """Some whole rows: UTF-8 bytes and the byte offset of each text."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray  # of text i: words doc[i]:doc[i + 1]


def texts_of(column: pa.Array) -> Texts:
    """Null texts become empty ones."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if offsets is None:
        return Texts(np.empty(0, np.uint8), np.zeros(1, np.int64))
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return Texts(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def blocks(batch: pa.RecordBatch, column: str, size: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The batch in slices of whole rows of about ``size`` bytes of text."""
    if not batch.num_rows:
        return
    whole = texts_of(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < whole.n:
        to = max(at + 1, int(np.searchsorted(whole.offsets, whole.offsets[at] + size, "right")) - 1)
        lo, hi = whole.offsets[at], whole.offsets[to]
        yield batch.slice(at, to - at), Texts(whole.data[lo:hi], whole.offsets[at : to + 1] - lo)
        at = to


def words_of(texts: Texts) -> Words:
    data, offsets = texts
    word = ~SEPARATOR[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    first[edges] = word[edges]
    last[edges - 1] = word[edges - 1]
    start = np.flatnonzero(first)
    return Words(start, np.flatnonzero(last) + 1, np.searchsorted(start, offsets))


def row_of(offsets: np.ndarray) -> np.ndarray:
    """For items offsets[i]:offsets[i + 1] of row i: the row of each item."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def windows(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words inside one text, and their offsets by text."""
    n = np.maximum(np.diff(doc) - width + 1, 0)
    offsets = np.concatenate([[0], np.cumsum(n)])
    if not offsets[-1]:
        return np.empty(0, U64), offsets
    total = len(hashes) - width + 1
    rolled = np.zeros(total, U64)
    for j in range(width):
        rolled = rolled * U64(BASE) + hashes[j : total + j]
    at = np.arange(offsets[-1]) + np.repeat(doc[:-1] - offsets[:-1], n)
    return mix(rolled[at]), offsets


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values[offsets[i]:offsets[i + 1]] for each i (empty: 0)."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
