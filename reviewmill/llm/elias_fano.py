"""Elias-Fano coded monotone sequences, and one level of an n-gram trie made of them.

A sequence of ``n`` numbers below ``2**bits`` is kept as ``low`` bits of each, packed, and the rest in unary.
Look-ups work on the coded form, many at a time.
"""

from __future__ import annotations

import numpy as np

# Most low bits of a number; they are packed into words of 64.
WIDEST = 56


class EliasFano:
    """A monotone sequence; ``low`` and ``high`` may be memory maps."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray):
        self.n, self.width, self.low, self.high = n, width, low, high
        self._starts = self._ones = None

    @classmethod
    def encode(cls, values: np.ndarray, bits: int) -> EliasFano:
        n = len(values)
        width = min(WIDEST, max(0, bits - max(n, 1).bit_length()))
        values = values.astype(np.uint64)
        begin = np.arange(n, dtype=np.int64) * width
        word, shift = begin >> 6, (begin & 63).astype(np.uint64)
        low = np.zeros((n * width >> 6) + 2, dtype="<u8")
        if n and width:
            bits_of = values & np.uint64((1 << width) - 1)
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low[word[first]] = np.bitwise_or.reduceat(bits_of << shift, first)
            over = np.flatnonzero(shift > np.uint64(64 - width))
            low[word[over] + 1] |= bits_of[over] >> (np.uint64(64) - shift[over])
        upper = (values >> np.uint64(width)).astype(np.int64)
        marks = np.zeros(n + (1 << (bits - width)) + 1, dtype=np.uint8)
        marks[upper + np.arange(n)] = 1
        return cls(n, width, low.view(np.uint8), np.packbits(marks, bitorder="little"))

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.width, len(self.low), len(self.high)], dtype="<i8")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_buffer(cls, data: np.ndarray) -> EliasFano:
        n, width, low, high = np.frombuffer(data[:32].tobytes(), dtype="<i8").tolist()
        return cls(n, width, data[32 : 32 + low], data[32 + low : 32 + low + high])

    def _select(self) -> np.ndarray:
        if self._ones is None:
            marks = np.unpackbits(self.high, bitorder="little").view(bool)
            self._ones = np.flatnonzero(marks)[: self.n]
            zeros = np.flatnonzero(~marks)
            self._starts = np.minimum(np.concatenate([[0], zeros - np.arange(len(zeros))]), self.n)
        return self._ones

    def _low(self, at: np.ndarray) -> np.ndarray:
        if not self.width:
            return np.zeros(len(at), dtype=np.uint64)
        begin = at * self.width
        word, shift = begin >> 6, (begin & 63).astype(np.uint64)
        words = self.low.view("<u8")
        # Two shifts in place of one, as a shift by 64 is none.
        both = (words[word] >> shift) | ((words[word + 1] << np.uint64(1)) << (np.uint64(63) - shift))
        return both & np.uint64((1 << self.width) - 1)

    def access(self, at: np.ndarray) -> np.ndarray:
        ones = self._select()
        return ((ones[at] - at).astype(np.uint64) << np.uint64(self.width)) | self._low(at)

    def decode(self) -> np.ndarray:
        return self.access(np.arange(self.n))

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, -1 where the sequence does not have it."""
        self._select()
        upper = (values >> np.uint64(self.width)).astype(np.int64)
        at, end = self._starts[upper].copy(), self._starts[upper + 1]
        low = values & np.uint64((1 << self.width) - 1)
        found = np.full(len(values), -1, dtype=np.int64)
        # Numbers with the same upper part are ordered by their low bits: halve what is left of each stretch.
        last = end.copy()
        open_ = np.flatnonzero(at < end)
        while len(open_):
            middle = (at[open_] + last[open_]) >> 1
            below = self._low(middle) < low[open_]
            at[open_[below]] = middle[below] + 1
            last[open_[~below]] = middle[~below]
            open_ = open_[at[open_] < last[open_]]
        inside = np.flatnonzero(at < end)
        hit = inside[self._low(at[inside]) == low[inside]]
        found[hit] = at[hit]
        return found


class Level:
    """N-grams of a shard: contexts, pointers to their successors, successors, and a code for each n-gram.

    An n-gram is a number whose ``upper`` first bits are its context and whose ``half`` last bits its last word. Successors are
    kept relative to their context: as numbers after the place of the context, which makes them monotone.
    """

    def __init__(self, contexts: EliasFano, pointers: EliasFano, successors: EliasFano, codes: np.ndarray, half: int):
        self.contexts, self.pointers, self.successors, self.codes, self.half = contexts, pointers, successors, codes, half

    @classmethod
    def build(cls, keys: np.ndarray, codes: np.ndarray, half: int, upper: int) -> Level:
        context, first = np.unique(keys >> np.uint64(half), return_index=True)
        place = np.repeat(np.arange(len(context)), np.diff(np.append(first, len(keys)))).astype(np.uint64)
        relative = (place << np.uint64(half)) | (keys & np.uint64((1 << half) - 1))
        return cls(
            EliasFano.encode(context, upper),
            EliasFano.encode(np.append(first, len(keys)), max(1, len(keys).bit_length())),
            EliasFano.encode(relative, half + max(1, len(context).bit_length())),
            codes,
            half,
        )

    def to_bytes(self) -> bytes:
        parts = [self.contexts.to_bytes(), self.pointers.to_bytes(), self.successors.to_bytes(), self.codes.tobytes()]
        return np.array([self.half, *map(len, parts)], dtype="<i8").tobytes() + b"".join(parts)

    @classmethod
    def from_buffer(cls, data: np.ndarray) -> Level:
        half, *sizes = np.frombuffer(data[:40].tobytes(), dtype="<i8").tolist()
        at = np.cumsum([40, *sizes])
        parts = [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        return cls(*(EliasFano.from_buffer(p) for p in parts[:3]), parts[3], half)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each n-gram or -1: first the context, then the word among the successors of that context."""
        context = self.contexts.find(keys >> np.uint64(self.half))
        out = np.full(len(keys), -1, dtype=np.int64)
        known = np.flatnonzero(context >= 0)
        if not len(known):
            return out
        at = context[known]
        relative = (at.astype(np.uint64) << np.uint64(self.half)) | (keys[known] & np.uint64((1 << self.half) - 1))
        place = self.successors.find(relative)
        inside = (place >= self.pointers.access(at).astype(np.int64)) & (place < self.pointers.access(at + 1).astype(np.int64))
        out[known] = np.where(inside, place, -1)
        return out
