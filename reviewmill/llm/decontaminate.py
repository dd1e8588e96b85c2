"""Benchmark passages in documents, by the q-gram lemma.

A passage of ``m`` characters that occurs with at most ``k`` edits shares ``m + 1 - (k + 1) * q`` of its q-grams
with the text, all on ``k + 1`` neighbouring diagonals (text position minus passage position). Common
q-grams are counted in overlapping bands of diagonals, as wide as the edits of the passage need; bands that reach the bound are verified by an
alignment inside the band. Texts are compared as lower-case letters and digits with single spaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import words

Q = 8
FILTER_BITS = 22
BAND = 64


@dataclass(frozen=True)
class Settings:
    """``edits``: share of a passage that may be changed; ``block_bytes``: passages that are compared, and so
    broadcast, at a time."""

    edits: float = 0.1
    block_bytes: int = 4_000_000


def normalized(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes with runs of other bytes as one space, their offsets, and where each byte stood."""
    letter = words.ALNUM[data]
    keep = letter.copy()
    keep[1:] |= letter[:-1] & ~letter[1:]
    where = np.flatnonzero(keep)
    return np.where(letter, words.FOLD[data], 32).astype(np.uint8)[where], np.searchsorted(where, offsets), where


def grams(data: np.ndarray) -> np.ndarray:
    """The ``Q`` bytes from each position on as one number."""
    n = max(0, len(data) - Q + 1)
    codes = np.zeros(n, dtype=np.uint64)
    for i in range(Q):
        codes |= data[i : i + n].astype(np.uint64) << np.uint64(8 * i)
    return codes


def _slot(codes: np.ndarray) -> np.ndarray:
    return ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


class Passages:
    """A block of passages with the index of their q-grams."""

    def __init__(self, items: list[tuple[int, str | None]], settings: Settings):
        self.ids, self.texts = [], []
        for item, text in items:
            raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
            data = normalized(raw, np.array([0, len(raw)]))[0]
            data = data[1:] if len(data) and data[0] == 32 else data
            data = data[:-1] if len(data) and data[-1] == 32 else data
            if len(data) >= Q:
                self.ids.append(item)
                self.texts.append(data)
        sizes = np.array([len(t) for t in self.texts], dtype=np.int64)
        # Of a short passage fewer edits are allowed, so that one common q-gram at least is left.
        self.budget = np.minimum((sizes * settings.edits).astype(np.int64), (sizes - Q) // Q)
        self.bound = sizes + 1 - (self.budget + 1) * Q
        # A band and the ``budget`` diagonals after it hold any ``budget + 1`` neighbours that begin in it, if
        # these are no more than the next band has.
        self.width = np.left_shift(1, np.ceil(np.log2(np.maximum(self.budget, BAND))).astype(np.int64))
        codes = [grams(t) for t in self.texts]
        item = np.repeat(np.arange(len(codes)), [len(c) for c in codes])
        place = np.concatenate([np.arange(len(c)) for c in codes]) if codes else np.zeros(0, dtype=np.int64)
        every = np.concatenate(codes) if codes else np.zeros(0, dtype=np.uint64)
        order = np.argsort(every, kind="stable")
        self.item, self.place = item[order], place[order]
        self.codes, self.first, self.times = np.unique(every[order], return_index=True, return_counts=True)
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[_slot(self.codes)] = True


def candidates(data: np.ndarray, offsets: np.ndarray, passages: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, passage and band of every band of diagonals that has enough q-grams of a passage."""
    codes = grams(data)
    at = np.flatnonzero(passages.filter[_slot(codes)])
    known = np.searchsorted(passages.codes, codes[at])
    known[known == len(passages.codes)] = 0
    good = passages.codes[known] == codes[at]
    at, known = at[good], known[good]
    row = np.searchsorted(offsets, at, side="right") - 1
    whole = at + Q <= offsets[row + 1]
    at, known, row = at[whole], known[whole], row[whole]
    times = passages.times[known]
    start = np.repeat(passages.first[known] - (np.cumsum(times) - times), times)
    hit = start + np.arange(len(start))
    item = passages.item[hit]
    row = np.repeat(row, times)
    # Shifted to be positive: a passage may begin before the text.
    longest = max(map(len, passages.texts), default=0)
    widest = int(passages.width.max(initial=BAND))
    shift = (longest // widest + 2) * widest
    diagonal = np.repeat(at, times) - offsets[row] - passages.place[hit] + shift
    width = passages.width[item]
    band = diagonal // width
    before = diagonal % width <= passages.budget[item]
    keys = ((row.astype(np.uint64) * np.uint64(len(passages.ids)) + item.astype(np.uint64)) << np.uint64(28)) + band.astype(np.uint64)
    keys = np.sort(np.concatenate([keys, keys[before] - np.uint64(1)]))
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    count = np.diff(np.append(first, len(keys)))
    pair = (keys[first] >> np.uint64(28)).astype(np.int64)
    row, item = pair // max(len(passages.ids), 1), pair % max(len(passages.ids), 1)
    enough = count >= passages.bound[item] if len(item) else np.zeros(0, dtype=bool)
    band = (keys[first] & np.uint64((1 << 28) - 1)).astype(np.int64) - shift // passages.width[item]
    return row[enough], item[enough], band[enough]


def align(passage: np.ndarray, regions: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Edits of the passage against each region within a band of ``width`` diagonals, and where it ends.

    Row ``i`` of the table stands at region positions ``i .. i + width - 1``; begin and end are free.
    """
    kind = np.int16 if len(passage) + width < 1 << 15 else np.int32
    lane = np.arange(width, dtype=kind)
    row = np.zeros((len(regions), width), dtype=kind)
    for i, letter in enumerate(passage):
        matched = row + (regions[:, i : i + width] != letter)
        matched[:, :-1] = np.minimum(matched[:, :-1], row[:, 1:] + 1)
        row = (np.minimum.accumulate(matched - lane, axis=1) + lane).astype(kind)
    best = row.argmin(axis=1)
    return row[np.arange(len(row)), best], best + len(passage)


def located(column: pa.Array, passages: Passages) -> Iterator[tuple[int, int, int, int, int]]:
    """``(row, passage, edits, first byte, end byte)`` of the best place of each passage in each text."""
    for begin, raw, raw_offsets in words.slices(column):
        data, offsets, where = normalized(raw, raw_offsets)
        rows, items, bands = candidates(data, offsets, passages)
        found = {}
        order = np.argsort(items, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(items[order])) + 1) if len(order) else []:
            item = int(items[part[0]])
            passage, budget = passages.texts[item], int(passages.budget[item])
            band = int(passages.width[item])
            width = band + 2 * budget + 1
            step = max(1, min(256, (1 << 20) // (len(passage) + width)))
            for low in range(0, len(part), step):
                some = part[low : low + step]
                left, first = bands[some] * band - budget, offsets[rows[some]]
                place = left[:, None] + np.arange(len(passage) + width)
                inside = (place >= 0) & (place < (offsets[rows[some] + 1] - first)[:, None])
                letters = np.where(inside, data[np.where(inside, place + first[:, None], 0)], 0)
                edits, ends = align(passage, letters, width)
                for r, d, e in zip(rows[some].tolist(), edits.tolist(), (left + ends).tolist(), strict=True):
                    if d <= budget and ((r, item) not in found or d < found[r, item][0]):
                        end = int(min(e, offsets[r + 1] - offsets[r]) + offsets[r]) - 1
                        start = int(max(end - len(passage) - d + 1, offsets[r]))
                        found[r, item] = (d, int(where[start] - raw_offsets[r]), int(where[end] - raw_offsets[r]) + 1)
        for (r, item), (d, start, end) in found.items():
            yield begin + r, item, d, start, end


def _find(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = shared.value
        for batch in batches:
            found = list(located(batch.column(1), passages))
            at = pa.array([f[0] for f in found], pa.int64())
            columns = [batch.column(0).take(at), pa.array([passages.ids[f[1]] for f in found], pa.int64())]
            columns += [pa.array([f[j] for f in found], pa.int64()) for j in (2, 3, 4)]
            yield pa.record_batch(columns, names=["doc_id", "item_id", "edits", "first_byte", "end_byte"])

    return run


def _clean(shared, column: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            keep[[f[0] for f in located(batch.column(column), shared.value)]] = False
            yield batch.filter(pa.array(keep))

    return run


def _blocks(benchmark: DataFrame, settings: Settings) -> Iterator:
    """The passages in broadcast blocks of about ``block_bytes``; only one block passes through the driver at a time."""
    spark = benchmark.sparkSession
    benchmark = benchmark.select("item_id", "text").filter("text IS NOT NULL")
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // settings.block_bytes) or 1
    numbered = benchmark.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    for block in range(blocks):
        rows = numbered.filter(F.col("block") == block).orderBy("item_id", "text").collect()
        yield spark.sparkContext.broadcast(Passages([(r.item_id, r.text) for r in rows], settings))


def find_passages(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Which documents hold which passages: ``doc_id, item_id, edits, first_byte, end_byte``.

    One row per document row and passage, with the place that has the fewest edits; the bytes hold the
    passage and at most ``edits`` characters before it. Passages of fewer than 8 letters and spaces are not
    searched, null texts hold nothing. Repeated passages give a row each, repeated documents too. The
    passages are compared in blocks whose size in bytes is bounded, each against all documents.
    """
    schema = "doc_id long, item_id long, edits long, first_byte long, end_byte long"
    texts = docs.select("doc_id", "text")
    return reduce(DataFrame.unionAll, [texts.mapInArrow(_find(block), schema) for block in _blocks(benchmark, settings)])


def decontaminate(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` whose ``text`` holds no passage, with their columns; nothing is shuffled."""
    for block in _blocks(benchmark, settings):
        docs = docs.mapInArrow(_clean(block, docs.columns.index("text")), docs.schema)
    return docs
