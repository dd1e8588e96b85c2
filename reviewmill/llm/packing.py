"""Vector bin packing of examples into training sequences.

A sequence has three limits: tokens, segments and loss-bearing tokens. Each task packs the examples of
its own part of the table, so nothing is shuffled. Sequences are filled one after the other: of the
waiting pieces that fit, the one with the largest dot product of its demands and what the sequence
still has free goes in (both as shares of the limits, weighted by how much of each is in demand). When
none fits, the best one is cut to fill the sequence to the last token. What is left at the end of a
task becomes sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from reviewmill.llm import tokens

# Pieces that wait to be packed: packing begins at the upper number and stops at the lower one, so that
# there is something to choose from.
WAITING = (1024, 256)
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Limits:
    """Limits of a sequence; ``tokens`` is a power of two."""

    tokens: int = 1024
    segments: int = 64
    loss_tokens: int = 1024


class Packer:
    """Packs the pieces of one task. A piece is ``(example, start, end)``; loss begins at ``prompt``."""

    def __init__(self, limits: Limits, first_sequence: int = 0):
        self.limits, self.sequence = limits, first_sequence
        self.caps = np.array([limits.tokens, limits.segments, limits.loss_tokens], dtype=np.float64)
        self.demand = np.zeros(3)
        self.waiting: list[tuple] = []
        self.need = np.zeros((0, 3))

    def _need(self, piece: tuple) -> tuple[int, int, int]:
        (_, _, prompt), start, end = piece
        return end - start, 1, max(0, end - max(start, prompt))

    def _largest_end(self, piece: tuple, free: np.ndarray) -> int:
        """Where the piece has to be cut to stay within what is free."""
        (_, _, prompt), start, end = piece
        return int(min(end, start + free[0], max(start, prompt) + free[2]))

    def add(self, example: tuple, length: int) -> Iterator[tuple]:
        """Take an example ``(key, payload, prompt)``; full sequences are cut off at once."""
        start = 0
        while length - start >= self.limits.tokens:
            end = self._largest_end((example, start, length), self.caps)
            yield example, start, end, self.sequence, 0
            self.sequence += 1
            start = end
        if start < length:
            self.waiting.append((example, start, length))
        if len(self.waiting) >= WAITING[0]:
            yield from self.pack(WAITING[1])

    def pack(self, keep: int = 0) -> Iterator[tuple]:
        """Fill sequences until at most ``keep`` pieces wait; with 0 all are packed."""
        need = np.array([self._need(p) for p in self.waiting], dtype=np.float64).reshape(-1, 3)
        alive = np.ones(len(need), dtype=bool)
        # Demands as shares of the limits, and one array for each limit, as the loop below runs once per piece.
        shares, (size, segments, loss) = need / self.caps, need.T.copy()
        while True:
            left = int(alive.sum())
            if left == 0 or (keep and left <= keep):
                break
            free = self.caps.copy()
            total = need[alive, 0].sum()
            if total < self.limits.tokens:
                free[0] = 1 << (int(total).bit_length() - 1)
            weight = need[alive].sum(axis=0) / self.caps
            weight /= max(weight.sum(), 1e-300)
            offset = 0
            while free[0] >= 1 and free[1] >= 1:
                score = np.where(alive, shares @ (weight * free / self.caps), -1.0)
                fits = np.where((size <= free[0]) & (segments <= free[1]) & (loss <= free[2]), score, -1.0)
                best = int(np.argmax(fits))
                if fits[best] < 0:
                    best = int(np.argmax(score))
                    if score[best] < 0:
                        break
                example, start, end = self.waiting[best]
                to = self._largest_end(self.waiting[best], free)
                if to <= start:
                    break
                yield example, start, to, self.sequence, offset
                free -= self._need((example, start, to))
                offset += to - start
                if to < end:
                    self.waiting[best] = (example, to, end)
                    need[best] = size[best], segments[best], loss[best] = self._need(self.waiting[best])
                    shares[best] = need[best] / self.caps
                else:
                    alive[best] = False
            self.sequence += 1
        self.waiting = [p for p, a in zip(self.waiting, alive, strict=True) if a]


def _pack(path: str, split, end_id: int | None, limits: Limits, prompts: bool, cache_parts: int, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path, split, cache_parts)
        width = encode.dtype.itemsize
        end = b"" if end_id is None else np.array([end_id], dtype=encode.dtype).tobytes()
        packer = Packer(limits, TaskContext.get().partitionId() << 33)

        def rows(pieces) -> pa.RecordBatch:
            columns = [[] for _ in range(7)]
            for (doc_id, ids, _), start, to, sequence, offset in pieces:
                piece = np.frombuffer(ids[start * width : to * width], dtype=encode.dtype).astype("<u4").tobytes()
                for column, value in zip(columns, (doc_id, start, to - start, piece, len(ids) // width, sequence, offset), strict=True):
                    column.append(value)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.record_batch(arrays, names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for part in tokens.slices(batch, 1, slice_bytes):
                prompt = part.column(2).to_pylist() if prompts else [0] * part.num_rows
                found = []
                for doc_id, ids, p in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist()), prompt, strict=True):
                    ids += end
                    found.extend(packer.add((doc_id, ids, p or 0), len(ids) // width))
                if found:
                    yield rows(found)
        if found := list(packer.pack()):
            yield rows(found)

    return run


def pack(
    docs: DataFrame,
    tokenizer: str,
    split=tokens.split_before_space,
    end_id: int | None = None,
    limits: Limits = Limits(),
    prompt_tokens: str | None = None,
    cache_parts: int = tokens.CACHE_PARTS,
    slice_bytes: int = tokens.SLICE_BYTES,
) -> DataFrame:
    """Pieces of all texts of ``docs(doc_id, text)`` with their place in a sequence.

    One row per piece: ``doc_id``, ``start`` and ``length`` in ids of its document, ``ids`` (little-endian
    32-bit), ``doc_tokens``, ``sequence_id`` and ``offset`` in the sequence. Column ``prompt_tokens`` may say
    how many ids at the beginning of a text bear no loss; by default all ids do. A null text is
    an empty one; without an end id it has no piece. Ids of sequences follow from the part of the table a
    task reads, so a repeated task gives the same rows. An example whose loss-bearing tokens are above their
    limit is cut as one that is too long. ``cache_parts`` and ``slice_bytes`` bound the memory of a Python worker
    (see :mod:`reviewmill.llm.tokens`) and do not change the rows.
    """
    columns = ["doc_id", "text"] + ([prompt_tokens] if prompt_tokens else [])
    run = _pack(tokenizer, split, end_id, limits, prompt_tokens is not None, cache_parts, slice_bytes)
    return docs.select(*columns).mapInArrow(run, SCHEMA)
