"""Words and shingles of Arrow string columns as numpy arrays, without an object per word.

All functions work on slices of a batch whose bytes are bounded (``slices``), so the arrays of
one slice stay small however long a batch is; a text longer than the bound is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
#: For work that takes some fifty bytes or more for each byte of text.
SMALL_SLICE_BYTES = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_STEPS = [np.uint64(pow(0xD1B54A32D192ED03, k, 1 << 64)) for k in range(64)]
_CODES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CODES[65:91] = _CODES[97:123]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    if column.null_count:
        column = pc.fill_null(column, pa.scalar("", column.type))
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    wide = np.int64 if large else np.int32
    _, offsets, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(rows, max(end, row + 1))
        yield row, end
        row = end


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit of a hash over all 64."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = -(-max(1, n - 1) // SMALL_SLICE_BYTES) * SMALL_SLICE_BYTES + 1
        for k, base in enumerate((_BASE, _INVERSE)):
            run = np.full(size, base, np.uint64)
            run[0] = 1
            _powers[k] = np.multiply.accumulate(run)
    return _powers[0][:n], _powers[1][:n]


def prefix_hash(data: np.ndarray, codes: np.ndarray = _CODES) -> np.ndarray:
    """``out[j] - out[i]``, times the inverse power at ``i``, is the hash of ``data[i:j]``."""
    up, _ = powers(len(data) + 1)
    out = np.empty(len(data) + 1, np.uint64)
    out[0] = 0
    np.cumsum(codes[data] * up[:-1], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the spans ``[start, end)``."""
    _, down = powers(len(prefix))
    return mixed((prefix[end] - prefix[start]) * down[start])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes but 0x20 and 0x09-0x0D) and each row's first word."""
    inside = ~_SPACE[data]
    n = len(data)
    opens, closes = inside.copy(), inside.copy()
    if n:
        opens[1:] &= ~inside[:-1]
        closes[:-1] &= ~inside[1:]
        heads, tails = offsets[:-1][offsets[:-1] < n], offsets[1:][offsets[1:] > 0] - 1
        opens[heads] |= inside[heads]
        closes[tails] |= inside[tails]
    start = np.flatnonzero(opens)
    return start, np.flatnonzero(closes) + 1, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with A-Z as a-z, and each row's first word."""
    start, end, first = word_spans(data, offsets)
    return span_hash(prefix_hash(data), start, end), first


def shingle_hashes(words: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``k``-word shingles, repeats included, and each row's first shingle.

    A row of fewer words has its whole sequence as one shingle, a row without words none.
    """
    counts = np.diff(first)
    n = len(words)
    total = np.zeros(n, np.uint64)
    for j in range(min(k, n)):
        total[: n - j] += words[j:] * _STEPS[j]
    rows = np.repeat(np.arange(len(counts)), counts)
    whole = np.arange(n) + k <= first[1:][rows]
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        sums = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = counts[short] > j
            sums[has] += words[first[:-1][short[has]] + j] * _STEPS[j]
        total[first[:-1][short]] = sums + counts[short].astype(np.uint64)
        whole[first[:-1][short]] = True
    taken = np.flatnonzero(whole)
    return mixed(total[taken]), np.searchsorted(taken, first)
