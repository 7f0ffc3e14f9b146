"""Vectorised text work inside tasks: words, polynomial hashes, sliding windows.

Texts arrive as Arrow columns; their UTF-8 bytes are used in place. Hashes are
64-bit Rabin-Karp polynomials modulo 2^64 over mixed symbols, taken from prefix
sums, so the hash of any span is one subtraction and one multiplication.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 19  # of text worked on at a time; what is held beside it is a multiple of it
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

#: Bytes of words split at white space: everything but space and 0x09 to 0x0D.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words of lower-cased letters, digits and everything beyond ASCII.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column and the n + 1 places where values begin; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if len(column) == 0 or places is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def release() -> None:
    """Give memory that is free, but still held by the allocators, back to the system."""
    _powers.cache_clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same work, after which a worker keeps no free memory: workers outlive their stage beside later ones."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return tidied


def tidy_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for a function of one group, after each of which the free memory goes back."""

    def tidied(table):
        try:
            return run(table)
        finally:
            release()

    return tidied


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of fewer, to bound what a task holds."""
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)


def blocks(places: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most so many bytes; a longer text is a run of its own."""
    i, n = 0, len(places) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(places, places[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return of(BASE), of(INVERSE)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(20, (max(size, 1) - 1).bit_length()))
    return up[:size], down[:size]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes, in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    up, _ = powers(len(symbols))
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * up, out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


class Words:
    """The words of a run of texts: hashes, and the index of each text's first word (n + 1)."""

    def __init__(self, data: np.ndarray, places: np.ndarray, table: np.ndarray):
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = table[data]
        cut = np.zeros(n + 1, bool)
        cut[places] = True
        self.starts = np.flatnonzero(inside[1:] & (cut | ~inside[:-1]))
        self.ends = np.flatnonzero(inside[:-1] & (cut | ~inside[1:]))
        self.first = np.searchsorted(self.starts, places)
        self.counts = np.diff(self.first)
        self.hashes = span_hashes(prefix_sums(data.astype(np.uint64) + np.uint64(1)), self.starts, self.ends)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of k words inside a text, and the index of each one's first word."""
        at = np.arange(len(self.hashes))
        last = np.repeat(self.first[1:], self.counts)
        at = at[at + k <= last]
        return span_hashes(self.sums, at, at + k), at

    @functools.cached_property
    def sums(self) -> np.ndarray:
        return prefix_sums(self.hashes)

    @functools.cached_property
    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` neighbours, by doubling."""
    least, reach = values, 1
    while 2 * reach <= width:
        least = np.minimum(least[:-reach], least[reach:]) if len(least) > reach else least[:0]
        reach *= 2
    rest = width - reach
    if not rest:
        return least
    return np.minimum(least[:-rest], least[rest:]) if len(least) > rest else least[:0]


def runs(values: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Where runs of equal neighbours begin, with the end of the last as final entry."""
    n = len(values)
    new = np.ones(n + 1, bool)
    if n:
        new[1:n] = values[1:] != values[:-1]
        for other in more:
            new[1:n] |= other[1:] != other[:-1]
    return np.flatnonzero(new) if n else np.zeros(1, np.int64)
