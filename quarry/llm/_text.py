"""Vectorised byte and word helpers shared by the operators' Arrow functions.

Everything here works on one bounded chunk of texts at a time: the texts' UTF-8
bytes back to back in one array, with the offset of each text. Words are hashed
with a polynomial over per-byte constants modulo 2**64, so a chunk costs a few
array passes and no Python work per word.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
# A chunk holds at most this many bytes of text (one longer text is its own chunk).
CHUNK_BYTES = (1 << 20) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (shift-multiply), so every bit depends on all."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column, back to back, and each row's offset (NULL: empty)."""
    binary = column.cast(pa.large_string()).cast(pa.large_binary())
    if binary.null_count:
        binary = binary.fill_null(b"")
    _, offsets, data = binary.buffers()
    offs = np.frombuffer(offsets, np.int64, len(binary) + 1, binary.offset * 8)
    if data is None or offs[-1] == offs[0]:
        return np.zeros(0, np.uint8), np.zeros(len(offs), np.int64)
    raw = np.frombuffer(data, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column, each of at most ``limit`` bytes (one row at least)."""
    lengths = np.diff(column_bytes(column)[1])
    start, size = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield start, len(lengths)


_tables: tuple[np.ndarray, np.ndarray] | None = None


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """``p**i`` and ``p**-i`` modulo 2**64 for ``i`` below ``size``.

    One pair of tables per process, as long as the longest chunk so far.
    """
    global _tables
    if _tables is None or len(_tables[0]) < size:
        n = 1 << max(16, (size - 1).bit_length())
        base = 0x9E3779B97F4A7C15 | 1
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(n, b, U64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=U64))
        _tables = out[0], out[1]
    return _tables[0][:size], _tables[1][:size]


@functools.cache
def byte_constants(fold: bool) -> np.ndarray:
    """One odd 64-bit constant per byte; with ``fold``, A-Z share those of a-z."""
    table = mix(np.arange(1, 257, dtype=U64) * U64(0xD1B54A32D192ED03)) | U64(1)
    if fold:
        table = table.copy()
        table[ord("A"):ord("Z") + 1] = table[ord("a"):ord("z") + 1]
    return table


@functools.cache
def space_table() -> np.ndarray:
    """True for the separators of ``[^\\x20\\x09-\\x0D]+`` words."""
    table = np.zeros(256, bool)
    table[[0x20, 9, 10, 11, 12, 13]] = True
    return table


@functools.cache
def punctuation_table() -> np.ndarray:
    """True for every ASCII byte that is neither a letter nor a digit."""
    table = np.zeros(256, bool)
    table[:128] = [not chr(b).isalnum() for b in range(128)]
    return table


def prefix_hash(data: np.ndarray, fold: bool) -> np.ndarray:
    """``h[i]`` = polynomial hash of the first ``i`` bytes; see ``range_hash``."""
    p, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(byte_constants(fold)[data] * p[:-1], dtype=U64, out=out[1:])
    return out


def range_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, equal for equal bytes wherever they stand."""
    _, q = powers(len(prefix))
    value = (prefix[ends] - prefix[starts]) * q[starts]
    return mix(value + (ends - starts).astype(U64))


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, start, end)`` of every maximal run of non-separator bytes inside a row."""
    return runs(~separators[data], offsets)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, start, end)`` of every maximal run of marked bytes inside a row."""
    if not len(inside):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    first = np.zeros(len(inside) + 1, bool)
    first[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return rows, starts, np.flatnonzero(ends) + 1


def shingles(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(row, hash)`` of every run of ``n`` words inside a row; rows with fewer words
    give their whole sequence as one, rows without words give none."""
    count = len(hashes)
    if not count:
        return rows, hashes
    total = np.zeros(max(count - n + 1, 0), U64)
    factor = 1
    for j in range(n):
        total += hashes[j:count - n + 1 + j] * U64(factor)
        factor = factor * 0x9FB21C651E98DF25 % (1 << 64)
    whole = rows[:max(count - n + 1, 0)] == rows[n - 1:] if count >= n else np.zeros(0, bool)
    out_rows, out = rows[:len(total)][whole], mix(total[whole] + U64(n))
    # Rows with one to n-1 words: their words combined alike, with their own count.
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    size = np.diff(np.r_[first, count])
    short = size < n
    if short.any():
        extra = np.zeros(int(short.sum()), U64)
        factor = 1
        for j in range(n - 1):
            at = first[short] + np.minimum(j, size[short] - 1)
            extra += np.where(j < size[short], hashes[at], U64(0)) * U64(factor)
            factor = factor * 0x9FB21C651E98DF25 % (1 << 64)
        out_rows = np.r_[out_rows, rows[first[short]]]
        out = np.r_[out, mix(extra + size[short].astype(U64))]
    return out_rows, out


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed long."""
    return x.view(np.int64)
