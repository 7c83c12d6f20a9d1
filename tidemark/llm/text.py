"""Words, hashes and shingles of Arrow text columns, computed on their UTF-8 bytes.

All word classes used here separate words by ASCII bytes only, so working on bytes gives the same words as
working on code points. NULL counts as the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of words of letters and digits: ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z.
LETTERS = np.zeros(256, dtype=bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    LETTERS[_first : _last + 1] = True

#: Bytes of words between white space: ``[^\x20\x09-\x0D]+``.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False

_PIECE = 1 << 20
_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash like a-z
_STEP = mix(np.arange(11, 19, dtype=np.uint64) * np.uint64(_ODD)) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_BASE = 0xD6E8FEB86659FD93
_POWER = _powers(_BASE, _PIECE)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), _PIECE)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows in them."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(column: pa.Array, most_bytes: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a text column that hold about ``most_bytes`` each; a longer text is a range alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    total, first = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if row > first and total + size > most_bytes:
            yield first, row
            total, first = 0, row
        total += size
    if first < len(sizes):
        yield first, len(sizes)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the first word of each row (one entry more than rows)."""
    if len(data) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    keep = table[data]
    begins, stops = keep.copy(), keep.copy()
    begins[1:] &= ~keep[:-1]
    stops[:-1] &= ~keep[1:]
    firsts = offsets[:-1][offsets[:-1] < len(data)]
    begins[firsts] = keep[firsts]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    stops[lasts] = keep[lasts]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word; A-Z hash like a-z."""
    byte = np.where(table, _BYTE, np.uint64(0))
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        begin = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, begin + _PIECE - 1, "right")))
        part = byte[data[begin : int(ends[last - 1]) + 1]]
        if len(part) <= int(ends[last - 1]) - begin:
            part = np.append(part, np.uint64(0))
        power, inverse = _POWER, _INVERSE
        if len(part) > _PIECE:  # a word longer than a piece
            power = _powers(_BASE, len(part))
        part *= power[: len(part)]
        at = starts[first:last] - begin
        bounds = np.empty(2 * (last - first), np.int64)
        bounds[0::2], bounds[1::2] = at, ends[first:last] - begin
        out[first:last] = np.add.reduceat(part, bounds)[0::2] * inverse[at]
        first = last
    return mix(out + (ends - starts).astype(np.uint64) * np.uint64(_ODD))


def shingles(hashes: np.ndarray, first: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's word shingles, repeats included, and the first shingle of each row.

    A row of fewer than ``width`` words, but not none, has one shingle: its whole sequence.
    """
    counts = np.diff(first)
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    offsets = np.concatenate([[0], np.cumsum(n)])
    total = len(hashes)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    every = np.full(total, width, np.uint64)
    for j in range(width):
        every += padded[j : j + total] * _STEP[j]
    whole = np.ones(total, dtype=bool)
    short = np.flatnonzero((counts > 0) & (counts < width))
    for j in range(1, width):  # the last positions of a row begin no shingle
        at = first[1:] - j
        whole[at[at >= first[:-1]]] = False
    for row in short.tolist():
        begin, size = int(first[row]), int(counts[row])
        whole[begin] = True
        every[begin] = np.uint64(size) + (hashes[begin : begin + size] * _STEP[:size]).sum(dtype=np.uint64)
    return mix(every[whole]), offsets


def text_shingles(column: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes over white-space words of a text column, and each row's first shingle."""
    data, offsets = utf8(column)
    starts, ends, first = words(data, offsets, NON_SPACE)
    return shingles(word_hashes(data, starts, ends, NON_SPACE), first, width)


def word_strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> pa.Array:
    """The words themselves, lower-cased, as an Arrow column."""
    sizes = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    kept = LOWER[data[table[data]]]
    buffers = [None, pa.py_buffer(sizes), pa.py_buffer(np.ascontiguousarray(kept))]
    return pa.Array.from_buffers(pa.large_binary(), len(starts), buffers)
