"""Word splitting and hashing over whole Arrow batches with numpy.

A batch of texts is one UTF-8 byte buffer plus row offsets. Words are maximal runs of bytes that a 256-entry table
calls word bytes; runs never cross a row. A word's 64-bit hash is a polynomial of its bytes modulo 2**64 (odd base, one
random odd 64-bit value per byte), read off one running sum per segment and then mixed. Work arrays are bounded by
``SEGMENT`` bytes (or one longer word), so a very long text costs a few bytes of memory per byte of text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 18
U64 = np.uint64


def table_of(separators: bytes, size: int = 256) -> np.ndarray:
    """True for every byte that belongs to a word."""
    t = np.ones(size, dtype=bool)
    t[list(separators)] = False
    return t


# The separators of words, x20 and x09-x0D.
WHITE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
SPACE_WORDS = table_of(WHITE)
# Words of ASCII digits, letters and every byte above x7F.
ALNUM_WORDS = table_of(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every bit of ``x`` over the whole word."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@lru_cache(maxsize=8)
def byte_values(seed: int, fold: bool) -> np.ndarray:
    v = mix(np.arange(1, 257, dtype=np.uint64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)
    return v[LOWER] if fold else v


def base_of(seed: int) -> int:
    """An odd base below 2**64 with 3 as its last three bits, so powers have a long period."""
    return (int(mix(np.array([seed + 77], dtype=np.uint64))[0]) & ~7) | 3


@lru_cache(maxsize=8)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def powers(seed: int, n: int, inverse: bool = False) -> np.ndarray:
    base = base_of(seed)
    size = max(SEGMENT + 1, 1 << int(n).bit_length())
    return _powers(pow(base, -1, 1 << 64) if inverse else base, size)[:n]


def run_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Polynomial hash of ``values[s:e]`` for every pair of ``starts`` and ``ends``, independent of position."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(seed, len(values)), out=total[1:])
    return mix((total[ends] - total[starts]) * powers(seed, len(values) + 1, inverse=True)[starts] + U64(seed))


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Row ranges that hold at most ``most`` bytes each, or one longer row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row offsets) of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offs, data = column.buffers()
    o = np.frombuffer(offs, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    o = o.astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[o[0] : o[-1]], o - o[0]


def spans(raw: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and per row the index of its first word (one entry more than rows)."""
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = table[raw]
    first = inside[1:] & ~inside[:-1]
    last = inside[:-1] & ~inside[1:]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(raw))]
    cut = cut[inside[cut] & inside[cut + 1]]
    first[cut] = True
    last[cut] = True
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(
    raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1, fold: bool = False
) -> np.ndarray:
    """64-bit hash of every word; ``fold`` reads A-Z as a-z."""
    out = np.empty(len(starts), dtype=np.uint64)
    values, i = byte_values(seed, fold), 0
    while i < len(starts):
        lo = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, lo + SEGMENT, side="right")))
        out[i:j] = run_hash(values[raw[lo : int(ends[j - 1])]], starts[i:j] - lo, ends[i:j] - lo, seed)
        i = j
    return out


def window_hashes(words: np.ndarray, size: int, seed: int = 2) -> np.ndarray:
    """Hash of ``words[i:i + size]`` for every i; windows may cross rows, the caller masks those."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.empty(n, dtype=np.uint64)
    for lo in range(0, n, SEGMENT // 2):
        hi = min(n, lo + SEGMENT // 2)
        at = np.arange(hi - lo)
        out[lo:hi] = run_hash(words[lo : hi + size - 1], at, at + size, seed)
    return out


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all elements of the runs ``starts[i] .. starts[i] + lengths[i]``, run after run."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)


def binary_column(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A binary column whose row i holds the bytes of ``values[bounds[i]:bounds[i + 1]]``."""
    data = np.ascontiguousarray(values)
    at = (np.asarray(bounds, dtype=np.int64) - bounds[0]) * data.itemsize
    data = data[int(bounds[0]) : int(bounds[-1])]
    if at[-1] < 2**31:
        return pa.Array.from_buffers(
            pa.binary(), len(bounds) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)]
        )
    return pa.array([data[int(a - bounds[0]) : int(b - bounds[0])].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.large_binary())
