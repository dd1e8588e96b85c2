"""Canonical Huffman codes of limited length over ids, coded and decoded as whole arrays.

Bits are stored with the most significant first. Every ``every`` ids the bit offset is recorded; the
decoder reads all these stretches side by side, one table look-up per id.
"""

from __future__ import annotations

import numpy as np

# Longest code of up to 65,536 symbols; more symbols have one bit more than they need at least.
MAX_LENGTH = 16
# The decoder reads a code from 32 bits that begin at a whole byte.
WIDEST = 25


def length_limit(n: int) -> int:
    return MAX_LENGTH if n <= 1 << MAX_LENGTH else (n - 1).bit_length() + 1


def code_lengths(counts: np.ndarray, limit: int | None = None) -> np.ndarray:
    """Bits per symbol by package merging: the shortest code in which no length is above ``limit``."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), dtype=np.uint8)
    n = len(used)
    if n == 0:
        return lengths
    limit = limit or length_limit(n)
    if n > 1 << limit or limit > WIDEST:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    if n == 1:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    items, is_leaf = leaves, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaves, packages])
        sort = np.argsort(merged, kind="stable")
        items = merged[sort]
        is_leaf.append(sort < n)
    take = 2 * n - 2
    for level in reversed(is_leaf):
        taken = int(level[:take].sum())
        lengths[order[:taken]] += 1
        take = 2 * (min(take, len(level)) - taken)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Code of each symbol: shorter codes first, equal lengths in the order of the ids."""
    codes = np.zeros(len(lengths), dtype=np.uint64)
    code, last = 0, 0
    for symbol in sorted(np.flatnonzero(lengths), key=lambda s: (lengths[s], s)):
        code <<= int(lengths[symbol]) - last
        codes[symbol], last = code, int(lengths[symbol])
        code += 1
    return codes


def decoding_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """For every run of as many bits as the longest code the id it begins with and the length of its code, and that length."""
    codes, width = canonical_codes(lengths), int(lengths.max(initial=1))
    ids, bits = np.zeros(1 << width, dtype=np.uint32), np.ones(1 << width, dtype=np.int64)
    for symbol in np.flatnonzero(lengths):
        free = width - int(lengths[symbol])
        low = int(codes[symbol]) << free
        ids[low : low + (1 << free)], bits[low : low + (1 << free)] = symbol, lengths[symbol]
    return ids, bits, width


def encode(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray, every: int) -> tuple[bytes, np.ndarray]:
    """The coded bytes, and the bit offset of every ``every``-th id."""
    size = lengths[ids].astype(np.int64)
    ends = np.cumsum(size)
    begins = ends - size
    word = begins >> 5
    shift = (64 - size - (begins & 31)).astype(np.uint64)
    value = codes[ids] << shift
    first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
    out = np.zeros(int(word[-1]) + 2, dtype=np.uint64)
    out[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
    out[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
    return out.astype(">u4").tobytes()[: (int(ends[-1]) + 7) // 8], begins[::every]


def decode(
    payloads: list[bytes], counts: list[int], checkpoints: list[np.ndarray], table: tuple[np.ndarray, np.ndarray, int], every: int
) -> list[np.ndarray]:
    """The ids of several blocks, all their stretches side by side."""
    ids, bits, width = table
    data = np.frombuffer(b"".join(payloads) + b"\0" * 5, dtype=np.uint8).astype(np.uint32)
    window = (data[:-3] << np.uint32(24)) | (data[1:-2] << np.uint32(16)) | (data[2:-1] << np.uint32(8)) | data[3:]
    mask = np.uint32((1 << width) - 1)
    begins = np.cumsum([0, *map(len, payloads)])[:-1] * 8
    at = np.concatenate([np.asarray(c, dtype=np.int64) + b for c, b in zip(checkpoints, begins, strict=True)])
    left = np.concatenate([np.minimum(every, n - np.arange(len(c)) * every) for c, n in zip(checkpoints, counts, strict=True)])
    out = np.zeros((len(at), every), dtype=np.uint32)
    last = len(window) - 1
    for step in range(int(left.max(initial=0))):
        np.minimum(at, last * 8, out=at)  # a stretch that has ended reads on without effect
        code = (window[at >> 3] >> (32 - width - (at & 7)).astype(np.uint32)) & mask
        out[:, step] = ids[code]
        at += bits[code]
    flat = out[np.arange(every) < left[:, None]]
    return np.split(flat, np.cumsum(counts)[:-1])
