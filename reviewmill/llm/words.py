"""Words and word shingles of Arrow text columns as arrays of hashes, without a Python loop per word.

A text is handled as its UTF-8 bytes. A class table of 256 entries says which bytes belong to words and
a fold table lower-cases A-Z; bytes of non-ASCII characters count as letters unless told otherwise.
The hash of a word comes from prefix sums of a polynomial in its bytes (modulo 2**64), so equal words
have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are worked off in slices of about so many bytes, which bounds the memory of a task (a byte takes about
# fifty in arrays); a longer text is a slice of its own, whose words are hashed in windows of this size.
SLICE_BYTES = 1 << 18

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

ALNUM = np.zeros(256, dtype=bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[32] = NOT_SPACE[9:14] = False

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> list[np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((BASE, INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    return mix(x + np.uint64((seed * 0xD1B54A32D192ED03 + 1) % (1 << 64)))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of consecutive rows; a null text is an empty one."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def spans(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray = ALNUM):
    """Starts, ends and row of every word: runs of bytes of one class, where class 0 (or False) separates.

    Words end at the end of a row.
    """
    kind = letters[data]
    change = np.ones(len(data) + 1, dtype=bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[offsets] = True
    starts = np.flatnonzero((kind != 0) & change[:-1])
    ends = np.flatnonzero((kind != 0) & change[1:]) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = FOLD) -> np.ndarray:
    """A 64-bit hash for each word."""
    hashes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        window = fold[data[base : ends[to - 1]]].astype(np.uint64) + np.uint64(1)
        up, down = _power_tables(len(window) + 1)
        sums = np.zeros(len(window) + 1, dtype=np.uint64)
        np.cumsum(window * up[: len(window)], out=sums[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        hashes[at:to] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        at = to
    return mix(hashes)


def words(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray = ALNUM) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word in order."""
    starts, ends, rows = spans(data, offsets, letters)
    return word_hashes(data, starts, ends), rows


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of ``size`` words; a shorter text that has words is one shingle."""
    counts = np.bincount(rows, minlength=n_rows)
    n = len(hashes)
    full = np.flatnonzero(rows[: n - size + 1] == rows[size - 1 :]) if n >= size else np.zeros(0, dtype=np.int64)
    values = np.zeros(len(full), dtype=np.uint64)
    for j in range(size):
        values += seeded(hashes[full + j], j)
    short = np.flatnonzero((counts > 0) & (counts < size))
    first = (np.cumsum(counts) - counts)[short]
    rest = counts[short].astype(np.uint64)
    for j in range(size - 1):
        inside = j < counts[short]
        part = np.zeros(len(short), dtype=np.uint64)
        part[inside] = seeded(hashes[first[inside] + j], j)
        rest = rest + part
    at = np.concatenate([full, first])
    order = np.argsort(at, kind="stable")
    return mix(np.concatenate([values, rest]))[order], np.concatenate([rows[full], short])[order]


def counted(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct 48-bit keys of each row with their counts, ordered by row and key. At most 65,536 rows."""
    packed = np.sort((rows.astype(np.uint64) << np.uint64(48)) | (keys >> np.uint64(16)))
    if not len(packed):
        return packed, packed.astype(np.int64), packed.astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
    counts = np.diff(np.append(first, len(packed)))
    unique = packed[first]
    return unique & np.uint64((1 << 48) - 1), (unique >> np.uint64(48)).astype(np.int64), counts


class Tally:
    """How often each of ``slots`` numbers comes. Numbers are held back until there are as many as slots, so a small
    slice does not cost a pass over all slots."""

    def __init__(self, slots: int):
        self.total, self.held, self.n = np.zeros(slots, dtype=np.int32), [], 0

    def add(self, found: np.ndarray) -> None:
        self.held.append(found.astype(np.int32))
        self.n += len(found)
        if self.n >= len(self.total):
            self.counts()

    def counts(self) -> np.ndarray:
        if self.held:
            self.total += np.bincount(np.concatenate(self.held), minlength=len(self.total)).astype(np.int32)
        self.held, self.n = [], 0
        return self.total


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(first row, rows, shingle, row in slice, count)`` for slices of a text column."""
    for begin, data, offsets in slices(column.slice(0)):
        for low in range(0, len(offsets) - 1, 1 << 16):
            part = offsets[low : low + (1 << 16) + 1]
            n = len(part) - 1
            hashes, rows = words(data[part[0] : part[-1]], part - part[0])
            keys, rows = shingles(hashes, rows, n, size)
            yield begin + low, n, *counted(keys, rows)
