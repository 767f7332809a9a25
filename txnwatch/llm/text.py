"""Vectorised word hashing inside Arrow batches, shared by the passage, join and benchmark operators.

Words are maximal runs of ``[^\\x20\\x09-\\x0D]``; in UTF-8 these six bytes never occur inside another character, so
the work is done on the bytes of the whole batch at once, without a Python loop over documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; one larger document is handled alone.
CHUNK_BYTES = 1 << 19
#: Odd multipliers of the polynomial hashes (any odd value works; fixed so that runs agree).
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
#: The finaliser's constants (splitmix64).
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(MIX[0])
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base, inverse = np.full(n, BYTE_BASE, np.uint64), np.full(n, pow(BYTE_BASE, -1, 1 << 64), np.uint64)
    base[0] = inverse[0] = 1
    return np.cumprod(base), np.cumprod(inverse)


def chunks(batch: pa.RecordBatch, text: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold at most ``most`` bytes; a larger text comes alone."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), np.int64)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and held + n > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if len(sizes) > start:
        yield batch.slice(start)


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all rows, where each row starts and the last one ends) of a string column; null rows are empty."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    if not len(column) or data is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def words(column: pa.Array, lower: bool, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hash of each word, the row of each word) of a string column; null rows have no word. ``apart`` marks the
    ASCII bytes that stand between words."""
    raw, offsets = raw_bytes(column)
    if not len(raw):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    inside = ~apart[raw]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(raw)]
    first[cuts] = inside[cuts]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    up, down = _powers(1 << max(19, int(len(raw)).bit_length()))
    if lower:
        raw = _LOWER[raw]
    value = np.where(inside, raw.astype(np.uint64) + np.uint64(1), np.uint64(0))
    value *= up[:len(raw)]
    # spaces add nothing, so the sum from one word start to the next is the word's own polynomial
    hashes = mix(np.add.reduceat(value, starts) * down[starts])
    row = np.searchsorted(offsets, starts, side="right") - 1
    return hashes, row


def grams(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, index of the first word) of all runs of k words that lie in one row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    at = np.flatnonzero(row[:n] == row[k - 1:])
    out, power = np.zeros(n, np.uint64), 1
    for j in range(k):
        out += hashes[j:j + n] * np.uint64(power)
        power = power * WORD_BASE % (1 << 64)
    return mix(out[at]), at


def lines(column: pa.Array) -> tuple[np.ndarray, ...]:
    """(hash, bytes, code points, row, number in the row) of each line of a string column's rows: of the line without white
    space at its ends, A-Z lower-cased. A null or empty row is one empty line; empty lines have hash 0."""
    raw, offsets = raw_bytes(column)
    rows = len(offsets) - 1
    cuts = np.flatnonzero(raw == 0x0A)
    row = np.r_[np.arange(rows), np.searchsorted(offsets, cuts, side="right") - 1]
    start = np.r_[offsets[:-1], cuts + 1]
    order = np.lexsort((start, row))
    row, start = row[order], start[order]
    last = np.r_[row[1:] != row[:-1], np.ones(min(1, len(row)), bool)]
    end = np.where(last, offsets[row + 1], np.r_[start[1:], 0][:len(start)] - 1)
    number = np.arange(len(row)) - np.searchsorted(row, row)
    inside = np.flatnonzero(~SPACE[raw])
    a, b = np.searchsorted(inside, start), np.searchsorted(inside, end)
    some = a < b
    first, after = inside[a[some]], inside[b[some] - 1] + 1
    up, down = _powers(1 << max(19, int(len(raw)).bit_length()))
    sums = np.r_[np.uint64(0), np.cumsum((_LOWER[raw].astype(np.uint64) + np.uint64(1)) * up[:len(raw)])]
    points = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    hashes, size, n = np.zeros(len(row), np.uint64), np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
    hashes[some], size[some], n[some] = mix((sums[after] - sums[first]) * down[first]), after - first, points[after] - points[first]
    return hashes, size, n, row, number


def shingles(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the k-word shingles; a row with 1 to k-1 words has its whole sequence as its only one."""
    out, at = grams(hashes, row, k)
    rows = row[at]
    if len(row):
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        counts = np.diff(np.r_[starts, len(row)])
        short = counts < k
        if short.any():
            more = np.zeros(short.sum(), np.uint64)
            power = 1
            for j in range(k - 1):
                has = counts[short] > j
                more[has] += hashes[starts[short][has] + j] * np.uint64(power)
                power = power * WORD_BASE % (1 << 64)
            out = np.r_[out, mix(more + counts[short].astype(np.uint64) * np.uint64(BYTE_BASE))]
            rows = np.r_[rows, row[starts[short]]]
    return out, rows
