"""Words of whole texts as numpy arrays, straight from Arrow buffers.

A word is a run of bytes outside space and 0x09-0x0D; in UTF-8 that is the same as over code points.
Letters A-Z are lower-cased. A word is known by a 64-bit hash: a polynomial over random byte values,
mixed with the length. Work goes in slices of bounded bytes; only a single longer text makes a longer one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15


@dataclass
class Words:
    """Words of consecutive rows: word i is ``data[start[i]:end[i]]``; row r has words first[r]:first[r+1]."""

    rows: slice
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def word(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace")


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Reader:
    """Splits string columns into ``Words``; holds the tables for it."""

    def __init__(self, lower: bool = True):
        values = np.arange(256)
        self.fold = np.where((values >= 65) & (values <= 90), values + 32, values).astype(np.uint8) if lower else None
        self.space = (values == 32) | ((values >= 9) & (values <= 13))
        self.random = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.power = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) >= n:
            return
        size = max(n, SLICE_BYTES)
        with np.errstate(over="ignore"):
            self.power = np.full(size, BASE, np.uint64)
            self.inverse = np.full(size, pow(BASE, -1, 1 << 64), np.uint64)
            self.power[0] = self.inverse[0] = 1
            np.multiply.accumulate(self.power, out=self.power)
            np.multiply.accumulate(self.inverse, out=self.inverse)

    def slices(self, column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Words]:
        """The words of a string column, null as empty; every row is in one slice, in order."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):  # no chunk at all
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
        column = column.cast(pa.large_string()).fill_null("")
        if not len(column):
            return
        _, offsets, data = column.buffers()
        offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield self._split(slice(at, to), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
            at = to

    def _split(self, rows: slice, data: np.ndarray, offsets: np.ndarray) -> Words:
        n = len(data)
        if self.fold is not None:
            data = self.fold[data]
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = ~self.space[data]
        opens = inside[1:-1] & ~inside[:-2]
        closes = inside[1:-1] & ~inside[2:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        opens[cuts] = inside[1:-1][cuts]
        closes[cuts - 1] = inside[1:-1][cuts - 1]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        first = np.searchsorted(start, offsets)
        self._powers(n)
        with np.errstate(over="ignore"):
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.random[data] * self.power[:n], out=sums[1:])
            hashes = (sums[end] - sums[start]) * self.inverse[start] if n else np.empty(0, np.uint64)
            hashes = mix(hashes + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        return Words(rows, data, start, end, first, hashes)


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows, and the first index of each row's windows.

    A row with fewer words, but some, has its whole sequence as its only window.
    """
    h, counts = words.hash, words.counts
    n = len(h)
    with np.errstate(over="ignore"):
        total = np.zeros(max(n - size + 1, 0), np.uint64)
        for j in range(size):
            total = mix(total + h[j : n - size + 1 + j] + np.uint64(j + 1))
        windows = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        first = np.concatenate([[0], np.cumsum(windows)])
        out = np.empty(first[-1], np.uint64)
        full = counts >= size
        source = np.repeat(words.first[:-1] - first[:-1], windows) + np.arange(first[-1])
        whole = np.repeat(full, windows)
        out[whole] = total[source[whole]]
        for r in np.flatnonzero(~full & (counts > 0)):
            value = np.uint64(size - counts[r]) * np.uint64(0xA0761D6478BD642F)
            for x in h[words.first[r] : words.first[r + 1]]:
                value = mix(np.array([value + x + np.uint64(7)]))[0]
            out[first[r]] = value
    return out, first
