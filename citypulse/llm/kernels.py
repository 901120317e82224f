"""Vectorised text kernels used inside Arrow batches.

Everything here works on the UTF-8 buffer of one Arrow string column slice
and on numpy arrays whose size follows that slice, never on per-row Python
strings. Polynomial hashes use arithmetic modulo 2**64 (numpy wraps), so a
prefix sum gives the hash of every span of the slice in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
SLICE_BYTES = 2_000_000

# ASCII letters and digits, and every byte of a multi-byte character.
WORD_BYTE = np.zeros(256, bool)
WORD_BYTE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_POW = {BASE: np.ones(1, U), BASE_INV: np.ones(1, U)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; grown on demand and kept."""
    have = _POW[base]
    if len(have) < n:
        table = np.full(max(n, SLICE_BYTES + 1), U(base))
        table[0] = 1
        have = _POW[base] = np.cumprod(table, dtype=U)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Zero-copy row slices whose text stays under ``limit`` bytes (one row at
    least), so working arrays stay bounded whatever the batch holds."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    end = np.cumsum(size.astype(np.int64))
    start, n = 0, batch.num_rows
    while start < n:
        base = end[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(end, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column without nulls."""
    if pa.types.is_large_string(col.type):
        offsets = np.frombuffer(col.buffers()[1], np.int64)
    else:
        offsets = np.frombuffer(col.buffers()[1], np.int32)
    offsets = offsets[col.offset:col.offset + len(col) + 1].astype(np.int64)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(col: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the column in order, and each row's first index.

    A word is a run of ASCII letters, digits and non-ASCII characters of the
    lower-cased text; null counts as empty. Returns (uint64 hashes, int64
    offsets of length rows + 1).
    """
    col = pc.fill_null(col, "")
    if lower:
        col = pc.utf8_lower(col)
    return spans(*utf8(col), WORD_BYTE)


def spans(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the maximal runs of bytes in class ``inside``, cut at rows."""
    n = len(data)
    if not n:
        return np.zeros(0, U), np.zeros(len(off), np.int64)
    is_in = inside[data]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    first = is_in.copy()
    first[1:] &= ~is_in[:-1] | edge[1:n]
    last = is_in.copy()
    last[:-1] &= ~is_in[1:] | edge[1:n]
    start, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    prefix = np.zeros(n + 1, U)
    np.cumsum((data.astype(U) + U(1)) * powers(BASE, n), out=prefix[1:])
    h = (prefix[stop] - prefix[start]) * powers(BASE_INV, n)[start]
    return mix(h), np.searchsorted(start, off)


def row_of(offsets: np.ndarray) -> np.ndarray:
    """Row number of each element described by ``offsets``."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def shingles(h: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every run of ``size`` words; a row with fewer words, but
    at least one, gives one shingle of all its words."""
    n = len(h)
    row = row_of(off)
    pad = np.concatenate([h, np.zeros(size, U)])
    room = off[row + 1] - np.arange(n) if n else np.zeros(0, np.int64)
    acc = np.zeros(n, U)
    for k in range(size):
        acc = acc * U(BASE) + np.where(room > k, pad[k:k + n], U(k + 1))
    keep = (room >= size) | (np.arange(n) == off[row])
    return mix(acc[keep]), row[keep]


def counted(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, hash) with counts, ordered by row then hash."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return h[at], row[at], np.diff(np.append(at, len(h)))


def sequence_digest(h: np.ndarray, off: np.ndarray, salt: int) -> np.ndarray:
    """64-bit digest of each row's word sequence; 0 words give the salt's mix."""
    n = len(h)
    prefix = np.zeros(n + 1, U)
    np.cumsum(mix(h ^ U(salt)) * powers(BASE, n), out=prefix[1:])
    value = (prefix[off[1:]] - prefix[off[:-1]]) * powers(BASE_INV, n + 1)[off[:-1]]
    return mix(value + np.diff(off).astype(U) * U(BASE) + U(salt))
