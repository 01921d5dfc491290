"""Vectorised words and hashes over the UTF-8 buffers of Arrow string columns.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``. All functions work on
whole batches of documents at once and never build Python strings.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

#: Bytes hashed at once; keeps the 64-bit temporaries in cache.
SEGMENT = 1 << 18


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets (n + 1) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 8 << 20):
    """Ranges of documents of about ``most`` bytes (a longer document is alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray, is_space: np.ndarray = SPACE):
    """Starts and ends (exclusive) of all words and the word offsets of documents."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    solid = ~is_space[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    first = solid.copy()
    first[1:] &= ~solid[:-1] | cut[1:n]
    last = solid.copy()
    last[:-1] &= ~solid[1:] | cut[1:n]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits (in place)."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _odd(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random odd numbers."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
               + np.uint64(seed * 0x632BE59BD9B4E019 % 2**64)) | np.uint64(1)


@lru_cache(maxsize=8)
def _base(seed: int):
    base = int(_odd(seed + 101, 1)[0]) // 8 * 8 + 3
    return _odd(seed, 256), base, pow(base, -1, 2**64)


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    got = _POWERS.get(base)
    if got is None or len(got) < n:
        m = max(n, SEGMENT + 1)
        seq = np.full(m, base, np.uint64)
        seq[0] = 1
        got = np.cumprod(seq, dtype=np.uint64)
        if m <= 4 * SEGMENT:
            _POWERS[base] = got
    return got[:n]


def word_hashes(data, starts, ends, seed: int = 0, fold: np.ndarray | None = None) -> np.ndarray:
    """64-bit hash of every word: polynomial in its bytes, mixed with its length.

    ``fold`` maps bytes first (``LOWER``: A-Z count as a-z).
    """
    table, base, inverse = _base(seed)
    if fold is not None:
        table = table[fold]
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)
    while i < n:
        lo = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, lo + SEGMENT, side="right")))
        part = data[lo:ends[j - 1]]
        total = np.empty(len(part) + 1, np.uint64)
        total[0] = 0
        np.cumsum(table[part] * powers(base, len(part)), out=total[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (total[e] - total[s]) * powers(inverse, len(part) + 1)[s]
        out[i:j] += (e - s).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        i = j
    return mix(out)


def window_hashes(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of k hashes: the last k - 1 starts have none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    mult = _odd(seed + 7, k)
    out = hashes[:n] * mult[0]
    for t in range(1, k):
        out += hashes[t:t + n] * mult[t]
    return mix(out)


def rows_of(offsets: np.ndarray) -> np.ndarray:
    """Document number of every item."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def distinct_shingles(hashes: np.ndarray, offsets: np.ndarray, k: int):
    """Sorted distinct k-word shingle hashes of every document and their offsets.

    Fewer than k words make one shingle of the whole sequence; none, no shingle.
    """
    n_docs, counts = len(offsets) - 1, np.diff(offsets)
    doc = rows_of(offsets)
    sh = window_hashes(hashes, k)
    d = doc[:len(sh)]
    full = d == doc[k - 1:] if len(sh) else np.zeros(0, bool)
    sh, d = sh[full], d[full]
    few = np.flatnonzero((counts > 0) & (counts < k))
    if len(few):
        extra = np.array([short_hash(hashes[offsets[i]:offsets[i + 1]]) for i in few], np.uint64)
        sh, d = np.concatenate([sh, extra]), np.concatenate([d, few])
    order = np.lexsort((sh, d))
    sh, d = sh[order], d[order]
    if len(sh):
        keep = np.empty(len(sh), bool)
        keep[0] = True
        keep[1:] = (sh[1:] != sh[:-1]) | (d[1:] != d[:-1])
        sh, d = sh[keep], d[keep]
    return sh, np.searchsorted(d, np.arange(n_docs + 1))


def short_hash(hashes: np.ndarray) -> np.uint64:
    """Hash of a whole short word sequence (other seed per length)."""
    return window_hashes(hashes, len(hashes), seed=1000 + len(hashes))[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Arrow string column from bytes and offsets."""
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
        pa.py_buffer(np.ascontiguousarray(data))).cast(pa.string())
