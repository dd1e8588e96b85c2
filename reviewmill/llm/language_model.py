"""N-gram language model of a corpus in sharded Elias-Fano tries, and the scores of its texts.

The corpus is cut into chunks of tokens, written once and bucketed by chunk. For each order the chunks
send their distinct n-grams with counts to shards (by a hash of the whole n-gram, so no context is ever
hot), a shard builds its level of the trie with quantised smoothed probabilities, memory-maps it and
looks up what each chunk asked for, and the answers go back to the chunks. N-grams travel as
Elias-Fano coded sets, not as rows.

The probability of a word after a context is ``(count + prior * p) / (context count + prior)`` with ``p`` its
probability after the context without its first word; single words have the probability of the base
score. This is a distribution over the known words and one unknown word.

A shard tells a chunk which of its n-grams no other chunk has. Nor can another chunk then have a longer one with
such a part: it stays with its chunk, counted there, and is neither sent nor asked for. All other training n-grams
are sent with their counts, so a level of the trie holds all that a second chunk could ask for. A chunk asks
only for n-grams whose count is open: it cannot be above the smaller count of its two parts, so when a
chunk itself has that many, it is known without asking.

N-grams are told apart by 64 bits in a shard, 40 of the context and 24 of the last word. Counts have 64 bits.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import words
from reviewmill.llm.elias_fano import EliasFano, Level
from reviewmill.session import cut_lineage, remove_path, scratch_path

END = np.uint64(0x5851F42D4C957F2D)  # hash of the end of a text
# Bits of the context and of the last word in the key of an n-gram; single words have two halves of 31 bits.
CONTEXT_BITS, WORD_BITS, SINGLE_BITS = 40, 24, 31
LOWER_STEP = 4096.0  # steps per unit of a base-10 logarithm in which lower probabilities travel


@dataclass(frozen=True)
class Settings:
    """``order``: words of the longest n-gram; ``prior``: weight of the shorter context in counts;
    ``chunk_tokens`` and ``shard_ngrams`` bound what one task holds."""

    order: int = 3
    prior: float = 4.0
    chunk_tokens: int = 1 << 20
    shard_ngrams: int = 1 << 21


def _chunks(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held_rows, hashes, tokens = TaskContext.get().partitionId() << 33, [], [], 0

        def row() -> pa.RecordBatch:
            known, ids = np.unique(np.concatenate(hashes), return_inverse=True)
            columns = {
                "chunk": [number],
                "doc_ids": [[r[0] for r in held_rows]],
                "held": [[r[1] for r in held_rows]],
                "sizes": [[r[2] for r in held_rows]],
                "words": [known.tobytes()],
                "ids": [ids.astype("<u4").tobytes()],
            }
            return pa.record_batch(columns, schema=CHUNK)

        for batch in batches:
            for begin, data, offsets in words.slices(batch.column(2)):
                found, rows = words.words(data, offsets, words.NOT_SPACE)
                n = len(offsets) - 1
                counts = np.bincount(rows, minlength=n)
                # The end mark goes after the words of each text.
                every = np.insert(found, np.cumsum(counts), END)
                part = batch.slice(begin, n)
                held_rows += zip(part.column(0).to_pylist(), part.column(1).to_pylist(), (counts + 1).tolist(), strict=True)
                hashes.append(every)
                tokens += len(every)
                if tokens >= settings.chunk_tokens:
                    yield row()
                    number, held_rows, hashes, tokens = number + 1, [], [], 0
        if held_rows:
            yield row()

    return run


CHUNK = pa.schema(
    {
        "chunk": pa.int64(),
        "doc_ids": pa.list_(pa.int64()),
        "held": pa.list_(pa.bool_()),
        "sizes": pa.list_(pa.int64()),
        "words": pa.binary(),
        "ids": pa.binary(),
    }
)
CHUNK_SCHEMA = "chunk long, doc_ids array<long>, held array<boolean>, sizes array<long>, words binary, ids binary"
SENT_SCHEMA = "shard int, chunk long, keys binary, counts binary, asked binary, context binary, lower binary"
ANSWER_SCHEMA = "chunk long, level int, shard int, counts binary, codes binary, book binary, alone binary, n long, v long"
ANSWER = pa.schema(
    [(n, t) for n, t in zip(
        ["chunk", "level", "shard", "counts", "codes", "book", "alone", "n", "v"],
        [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()],
        strict=True,
    )]
)


def _packed(values: np.ndarray, dtype: str) -> bytes:
    """Numbers byte plane by byte plane, as many as the largest needs; planes of small numbers compress well."""
    values = values.astype(dtype)
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = [(values >> values.dtype.type(8 * i)).astype(np.uint8).tobytes() for i in range(width)]
    return bytes([width]) + zlib.compress(b"".join(planes), 1)


def _packed_bits(values: np.ndarray) -> bytes:
    return zlib.compress(np.packbits(values).tobytes(), 1)


def _unpacked_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(data), np.uint8), count=n).astype(bool)


def _unpacked(data: bytes, dtype: str) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(memoryview(data)[1:]), dtype=np.uint8).reshape(data[0], -1)
    values = planes[0].astype(dtype)
    for i in range(1, len(planes)):
        values |= planes[i].astype(dtype) << values.dtype.type(8 * i)
    return values


def _ranked(ordered: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a new number begins in ``ordered``, and for the place ``at`` of each the position among the distinct ones."""
    new = np.ones(len(ordered), dtype=bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    inverse = np.empty(len(ordered), dtype=np.int64)
    inverse[at] = np.cumsum(new) - 1
    return new, inverse


def _distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``np.unique`` of numbers from 0 with first places and inverse; number and place are sorted as one where 63 bits hold both."""
    bits = len(codes).bit_length()
    if len(codes) and int(codes.max()).bit_length() + bits <= 63:
        ordered = np.sort((codes << bits) | np.arange(len(codes)))
        at = ordered & ((1 << bits) - 1)
        ordered >>= bits
    else:
        at = np.argsort(codes, kind="stable")
        ordered = codes[at]
    new, inverse = _ranked(ordered, at)
    return ordered[new], at[new], inverse


@dataclass
class Grams:
    """The distinct n-grams of one order in a chunk."""

    at: np.ndarray  # n-gram that starts at each token, -1 where the text ends before
    hashes: np.ndarray
    counts: np.ndarray  # in all training texts, once known
    probability: np.ndarray
    alone: np.ndarray  # in no other chunk


class Chunk:
    """A chunk with the model's answers so far; ``grams[n]`` is known up to the last answered level."""

    def __init__(self, row: dict, settings: Settings, shards: int, total: tuple[int, int]):
        self.settings, self.shards, (self.n, self.v) = settings, shards, total
        self.vocabulary = np.frombuffer(row["words"], dtype=np.uint64)
        self.ids = np.frombuffer(row["ids"], dtype="<u4").astype(np.int64)
        self.sizes = np.array(row["sizes"], dtype=np.int64)
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.train = ~np.array(row["held"], dtype=bool)[self.doc]
        self.answers: dict[int, list[dict]] = {}
        for answer in sorted(row.get("answers") or [], key=lambda a: a["shard"]):
            self.answers.setdefault(answer["level"], []).append(answer)
        self.grams: dict[int, Grams] = {}

    def _order(self, keys: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shard of each key, and the order in which keys are sent: by shard, then by key."""
        shard = (words.seeded(hashes, 7) % np.uint64(self.shards)).astype(np.int64)
        order = np.argsort(keys)
        # Equal keys stay in their order: only those few are sorted again.
        ordered = keys[order]
        equal = ordered[1:] == ordered[:-1]
        tied = np.flatnonzero(np.append(equal, False) | np.append(False, equal))
        order[tied] = order[tied][np.lexsort((order[tied], ordered[tied]))]
        # Numbers of 16 bits are sorted by counting.
        number = shard[order].astype(np.uint16) if self.shards <= 1 << 16 else shard[order]
        return shard, order[np.argsort(number, kind="stable")]

    def _sent(self, keys: np.ndarray, shard: np.ndarray, order: np.ndarray, bits: int, local, asked, context=None, lower=None) -> Iterator[dict]:
        """Counts go with all keys, contexts and lower probabilities only with those that are asked for."""
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        for part in np.split(order, cuts) if len(order) else []:
            open_ = part[asked[part]]
            yield {
                "shard": int(shard[part[0]]),
                "keys": EliasFano.encode(keys[part], bits).to_bytes(),
                "counts": _packed(local[part], "<u8"),
                "asked": _packed_bits(asked[part]),
                "context": None if context is None or not len(open_) else _packed(context[open_], "<u8"),
                "lower": None if lower is None or not len(open_) else _packed(lower[open_], "<u2"),
            }

    def _alone(self, level: int, shard: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Which of the n-grams that were sent no other chunk has."""
        found = np.zeros(len(order), dtype=bool)
        sizes = np.bincount(shard, minlength=self.shards)
        parts = [_unpacked_bits(a["alone"], int(sizes[a["shard"]])) for a in self.answers.get(level, [])]
        if parts:
            found[order] = np.concatenate(parts)
        return found

    def level(self, level: int, send: bool = False) -> Iterator[dict]:
        """What the chunk sends at a level whose lower levels are answered; otherwise ``grams`` is filled in from the answers."""
        if level == 1:
            keys, local = self.vocabulary >> np.uint64(64 - 2 * SINGLE_BITS), np.bincount(self.ids[self.train], minlength=len(self.vocabulary))
            shard, order = self._order(keys, self.vocabulary)
            if send:
                yield from self._sent(keys, shard, order, 2 * SINGLE_BITS, local, np.ones(len(keys), dtype=bool))
                return
            counts = np.zeros(len(keys), dtype=np.int64)
            counts[order] = np.concatenate([_unpacked(a["counts"], "<u8") for a in self.answers[1]])
            self.grams[1] = Grams(self.ids, self.vocabulary, counts, (counts + 0.1) / (self.n + 0.1 * (self.v + 1)), self._alone(1, shard, order))
            return
        shorter, prior = self.grams[level - 1], self.settings.prior
        size = len(self.vocabulary)
        n = len(self.ids) - level + 1
        start = np.flatnonzero(self.doc[:n] == self.doc[level - 1 :]) if n > 0 else np.zeros(0, dtype=np.int64)
        codes = shorter.at[start] * size + self.ids[start + level - 1]
        unique, first, inverse = _distinct(codes)
        local = np.bincount(inverse[self.train[start]], minlength=len(unique))
        context, rest, word = unique // max(size, 1), shorter.at[start[first] + 1], self.vocabulary[unique % max(size, 1)]
        bound = np.minimum(shorter.counts[context], shorter.counts[rest])
        lower, above = shorter.probability[rest], shorter.counts[context]
        hashes = words.mix(shorter.hashes[context] * np.uint64(0x9E3779B97F4A7C15) + word)
        # What no other chunk has is counted here. Of the rest another chunk may ask for what is known
        # here, so all training n-grams go along.
        alone, asked = shorter.alone[context] | shorter.alone[rest], local < bound
        sent = np.flatnonzero(~alone & ((local > 0) | asked))
        asked = asked[sent]
        context_part = words.seeded(shorter.hashes[context[sent]], 8) >> np.uint64(64 - CONTEXT_BITS)
        keys = (context_part << np.uint64(WORD_BITS)) | (words.seeded(word[sent], 9) >> np.uint64(64 - WORD_BITS))
        shard, order = self._order(keys, hashes[sent])
        if send:
            travelling = np.minimum(np.round(-np.log10(lower[sent]) * LOWER_STEP), 65535)
            yield from self._sent(keys, shard, order, CONTEXT_BITS + WORD_BITS, local[sent], asked, above[sent], travelling)
            return
        counts = local.astype(np.int64)
        probability = (counts + prior * lower) / (above + prior)
        if asked.any():
            answers = [a for a in self.answers[level] if a["counts"] is not None]
            found = np.concatenate([_unpacked(a["counts"], "<u8") for a in answers]).astype(np.int64)
            coded = np.concatenate([np.frombuffer(a["book"], "<f4")[np.frombuffer(zlib.decompress(a["codes"]), np.uint8)] for a in answers])
            at = sent[order][asked[order]]
            counts[at] = found
            smoothed = prior * lower[at] / (above[at] + prior)
            probability[at] = np.where(found > 0, 10.0 ** coded.astype(np.float64), smoothed)
        if level < self.settings.order:
            alone[sent] = self._alone(level, shard, order)
        at = np.full(len(self.ids), -1, dtype=np.int64)
        at[start] = inverse
        self.grams[level] = Grams(at, hashes, counts, probability, alone)

    def fill(self, level: int) -> None:
        for done in range(1, level + 1):
            for _ in self.level(done):
                raise AssertionError("a level is not answered")

    def scores(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known tokens, base score and score of each text."""
        order = self.settings.order
        self.fill(order)
        first = np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        depth = np.minimum(np.arange(len(self.ids)) - first + 1, order)
        log = np.zeros(len(self.ids))
        for level in range(1, order + 1):
            here = np.flatnonzero(depth == level)
            log[here] = np.log10(self.grams[level].probability[self.grams[level].at[here - level + 1]])
        single = self.grams[1]
        sums = [np.bincount(self.doc, weights=w, minlength=len(self.sizes)) for w in ((single.counts > 0)[self.ids], np.log10(single.probability)[self.ids], log)]
        return sums[0].astype(np.int64), sums[1], sums[2]


def _send(level: int, settings: Settings, shards: int, total: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = Chunk(row, settings, shards, total)
                chunk.fill(level - 1)
                sent = [r | {"chunk": row["chunk"]} for r in chunk.level(level, send=True)]
                yield pa.RecordBatch.from_pylist(sent, schema=SENT)

    return run


SENT = pa.schema(
    [("shard", pa.int32()), ("chunk", pa.int64())] + [(n, pa.binary()) for n in ("keys", "counts", "asked", "context", "lower")]
)


def _mapped(data: bytes) -> np.ndarray:
    """The bytes as a memory map of a file that has no name any more, so nothing is left behind."""
    handle, path = tempfile.mkstemp()
    try:
        with os.fdopen(handle, "wb") as file:
            file.write(data)
        return np.asarray(np.memmap(path, dtype=np.uint8, mode="r"))
    finally:
        os.unlink(path)


def _quantised(log: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and the code book: all values if they are few, else 256 at even steps of their distribution."""
    if not len(log):
        return np.zeros(0, dtype=np.uint8), np.zeros(256, dtype="<f4")
    book = np.unique(log)
    if len(book) <= 256:
        book = np.append(book, np.full(256 - len(book), book[-1])).astype("<f4")
    else:
        book = np.quantile(log, (np.arange(256) + 0.5) / 256).astype("<f4")
    return np.searchsorted((book[1:] + book[:-1]) / 2, log).astype(np.uint8), book


def _answer(level: int, settings: Settings):
    half, upper = (SINGLE_BITS, SINGLE_BITS) if level == 1 else (WORD_BITS, CONTEXT_BITS)

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [EliasFano.from_buffer(np.frombuffer(r["keys"], dtype=np.uint8)).decode() for r in rows]
        # What each chunk sent is in order, so this sort only merges.
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        ordered = every[order]
        new, inverse = _ranked(ordered, order)
        every = ordered[new]
        total = np.zeros(len(every), dtype=np.int64)
        np.add.at(total, inverse, np.concatenate([_unpacked(r["counts"], "<u8") for r in rows]).astype(np.int64))
        seen = total > 0
        # A chunk sends an n-gram once.
        alone = np.bincount(inverse, minlength=len(every)) == 1
        places = np.split(inverse, np.cumsum([len(k) for k in keys])[:-1])
        asked = [p[_unpacked_bits(r["asked"], len(p))] for r, p in zip(rows, places, strict=True)]
        codes, book = np.zeros(0, dtype=np.uint8), None
        if level > 1:
            context, lower, wanted = np.zeros(len(every)), np.ones(len(every)), np.zeros(len(every), dtype=bool)
            for row, part in zip(rows, asked, strict=True):
                if len(part):
                    wanted[part] = True
                    context[part] = _unpacked(row["context"], "<u8")
                    lower[part] = 10.0 ** (_unpacked(row["lower"], "<u2") / -LOWER_STEP)
            # What nobody asks for has its count in the trie, but no code that is read.
            codes = np.zeros(len(every), dtype=np.uint8)
            log = np.log10((total + settings.prior * lower) / (context + settings.prior))
            codes[seen & wanted], book = _quantised(log[seen & wanted])
            codes = codes[seen]
        trie, total = Level.from_buffer(_mapped(Level.build(every[seen], codes, half, upper).to_bytes())), total[seen]
        # Each n-gram is looked up once, whoever asked for it.
        place = trie.find(every)
        counts = np.where(place >= 0, np.append(total, 0)[place], 0)
        codes = np.where(place >= 0, np.append(trie.codes, np.uint8(0))[place], 0).astype(np.uint8) if level > 1 else None
        out = []
        for row, sent, part in zip(rows, places, asked, strict=True):
            answer = {"chunk": row["chunk"], "level": level, "shard": row["shard"], "counts": None, "codes": None, "book": None, "alone": None, "n": None, "v": None}
            if len(part):
                answer["counts"] = _packed(counts[part], "<u8")
                if book is not None:
                    answer |= {"codes": zlib.compress(codes[part].tobytes(), 1), "book": book.tobytes()}
            if level < settings.order:
                answer["alone"] = _packed_bits(alone[sent])
            if len(part) or level < settings.order:
                out.append(answer)
        nothing = dict.fromkeys(("chunk", "counts", "codes", "book", "alone"))
        out.append(nothing | {"level": level, "shard": rows[0]["shard"], "n": int(total.sum()), "v": len(total)})
        return pa.Table.from_pylist(out, schema=ANSWER)

    return run


def _score(settings: Settings, shards: int, total: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                chunk = Chunk(row, settings, shards, total)
                known, base, score = chunk.scores()
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(row["held"]), pa.array(chunk.sizes), pa.array(known), pa.array(base), pa.array(score)]
                yield pa.record_batch(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def score_corpus(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Learn from the rows of ``docs(doc_id, text, held_out)`` that are not held out, and score all.

    One row per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` (base-10 logarithms of
    the probability of the words and the end of the text). A null text is an empty one, with the end as its only
    token; a null ``held_out`` counts as true. Without training texts all words are unknown.
    """
    spark = docs.sparkSession
    rows = docs.select("doc_id", F.coalesce("held_out", F.lit(True)).alias("held"), F.coalesce("text", F.lit("")).alias("text"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // (16 * settings.chunk_tokens)))
    # Bucketed by chunk, so that answers are brought to the chunks and not chunks to the answers.
    name = f"language_model_chunks_{uuid.uuid4().hex}"
    written = rows.mapInArrow(_chunks(settings), CHUNK_SCHEMA).write.option("compression", "zstd")
    # A table by name, as only those are bucketed; its files lie in the shared folder.
    path = scratch_path(spark, "chunks")
    written.option("path", path).bucketBy(buckets, "chunk").saveAsTable(name)
    try:
        chunks = spark.table(name)
        tokens = chunks.agg(F.sum(F.length("ids"))).first()[0] or 0
        shards = max(1, tokens // 4 // settings.shard_ngrams)
        answers, total = None, (0, 0)

        def answered() -> DataFrame:
            if answers is None:
                return chunks
            return chunks.join(answers.groupBy("chunk").agg(F.collect_list(F.struct("level", "shard", "counts", "codes", "book", "alone")).alias("answers")), "chunk", "left")

        for level in range(1, settings.order + 1):
            sent = answered().mapInArrow(_send(level, settings, shards, total), SENT_SCHEMA)
            found = cut_lineage(sent.groupBy("shard").applyInArrow(_answer(level, settings), ANSWER_SCHEMA), "answers")
            if level == 1:
                total = tuple(x or 0 for x in found.agg(F.sum("n"), F.sum("v")).first())
            found = found.filter("chunk IS NOT NULL")
            answers = found if answers is None else answers.union(found)
        schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
        scores = cut_lineage(answered().mapInArrow(_score(settings, shards, total), schema), "scores")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_path(spark, path)
    return scores.withColumn("train_tokens", F.lit(total[0]).cast("long"))
