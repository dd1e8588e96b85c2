"""Quality classifier by importance resampling of texts with hashed n-gram models.

Two generative models are counted over hashed n-grams: one of the target (labelled good texts), one of
all texts. A text has an n-gram or not, so a word that one text repeats does not count as frequent.
The log ratio of the models is taken at the end of its confidence interval that is nearer to zero,
so n-grams that are too rare to judge weigh nothing. The weight of a text is the sum over its n-grams,
at most 1 (as good as a target text). Gumbel top-k then samples without replacement, as many
texts as the weights add up to.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import words
from reviewmill.session import cut_lineage

# Names of columns that a table under work gets for a while.
WEIGHT, KEY = "_op5_log_weight", "_op5_sampling_key"
# A repeat pattern is a period of up to so many tokens that goes on for so many tokens.
PERIODS, RUN = 4, 6
# Letters and digits make one kind of token, other signs another one.
SIGNS = np.where(words.ALNUM, 1, np.where(words.NOT_SPACE, 2, 0)).astype(np.uint8)


@dataclass(frozen=True)
class Settings:
    """``slots``: hashed n-grams (two counts each, broadcast as one float), half of them for each of two hashes;
    ``target_rows``: labelled texts the target model is fitted on at most; ``deviations``: width of the confidence interval;
    ``least_ratio``: n-grams whose models differ by a smaller factor weigh nothing;
    ``sharpness``: factor of the log weights against the sampling noise."""

    slots: int = 1 << 20
    target_rows: int = 100_000
    deviations: float = 3.0
    least_ratio: float = 2.0
    sharpness: float = 4.0
    seed: int = 29


def _repeats(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One n-gram per period of up to ``PERIODS`` tokens that a text repeats over and over, whatever the tokens."""
    found = []
    for period in range(1, PERIODS + 1):
        if len(hashes) < period + RUN:
            break
        same = (hashes[period:] == hashes[:-period]) & (rows[period:] == rows[:-period])
        run = np.convolve(same, np.ones(RUN, dtype=np.int64), "valid") == RUN
        found.append((np.full(int(run.sum()), period, dtype=np.uint64), rows[period + RUN - 1 :][run]))
    keys, at = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return words.seeded(keys, 3), at


def _ngrams(column: pa.Array, slots: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, rows, slot, row)`` of the distinct single tokens, pairs and repeat patterns of each text.

    An n-gram has two slots, so that a slot that it shares with another one by chance can be told.
    """
    for begin, data, offsets in words.slices(column):
        for low in range(0, len(offsets) - 1, 1 << 16):
            part = offsets[low : low + (1 << 16) + 1]
            hashes, rows = words.words(data[part[0] : part[-1]], part - part[0], SIGNS)
            pairs = np.flatnonzero(rows[1:] == rows[:-1])
            both = words.seeded(hashes[pairs], 1) + words.seeded(hashes[pairs + 1], 2)
            again, where = _repeats(hashes, rows)
            keys, rows, _ = words.counted(
                np.concatenate([hashes, words.mix(both), again]), np.concatenate([rows, rows[pairs], where])
            )
            half = np.uint64(slots // 2)
            first, second = keys % half, (keys // half) % half + half
            yield begin + low, len(part) - 1, np.stack([first, second]).astype(np.int64), rows


def _counts(settings: Settings):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, target = words.Tally(settings.slots), words.Tally(settings.slots)
        for batch in batches:
            good = batch.column(1).to_numpy(zero_copy_only=False)
            for begin, n, slot, row in _ngrams(batch.column(0), settings.slots):
                every.add(slot.ravel())
                target.add(slot[:, good[begin : begin + n][row]].ravel())
        total = every.counts(), target.counts()
        used = np.flatnonzero(total[0])
        for low in range(0, len(used), 1 << 16):
            part = used[low : low + (1 << 16)]
            yield pa.record_batch(
                [pa.array(part.astype(np.int32)), pa.array(total[0][part].astype(np.int64)), pa.array(total[1][part].astype(np.int64))],
                names=["slot", "n", "target"],
            )

    return run


def log_ratios(n: np.ndarray, target: np.ndarray, deviations: float, least_ratio: float) -> np.ndarray:
    """Cautious log ratio of the target model to the model of all texts for every slot.

    The rate of the two is set so that the median n-gram (by count) has ratio 1: the share of junk in all
    texts then does not show in the n-grams of good ones.
    """
    seen = n > 0
    if not target.any():
        return np.zeros(len(n), dtype=np.float32)
    share = target[seen] / n[seen]
    order = np.argsort(share, kind="stable")
    weight = np.cumsum(n[seen][order])
    rate = max(share[order][np.searchsorted(weight, weight[-1] / 2)], 1e-12)
    expected = np.maximum(n * rate, 1e-12)
    spread = deviations * np.sqrt(target + 1)
    high, low = np.log((target + spread) / expected), np.log(np.maximum(target - spread, 1e-12) / expected)
    cautious = np.where(target < expected, np.minimum(high, 0), np.maximum(low, 0))
    return np.where(np.abs(cautious) < np.log(least_ratio), 0, cautious).astype(np.float32)


def _log_weights(settings: Settings, ratios):
    """The log weight of a text; null for a text without tokens. Only texts go to Python, and only numbers come back."""

    @F.arrow_udf("double")
    def weigh(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        ratio = ratios.value
        for texts in batches:
            parts = []
            for _, n, slot, row in _ngrams(texts, settings.slots):
                first, second = ratio[slot]
                nearer = np.where(np.abs(first) < np.abs(second), first, second)
                total = np.bincount(row, weights=np.where(first * second > 0, nearer, 0), minlength=n)
                parts.append(pa.array(np.minimum(total, 0.0), mask=np.bincount(row, minlength=n) == 0))
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.float64())

    return weigh


def _kth_largest(rows: DataFrame, column: str, k: int) -> int:
    """The ``k``-th largest value of a long column, by four counts of 16 bits each from the top.

    Each count has at most 65,536 rows, whatever the number of values.
    """
    prefix, shift = 0, 48
    values = rows.select(F.col(column).alias("v"))
    while shift >= 0:
        digit = F.shiftright("v", shift)
        inside = values if shift == 48 else values.filter(F.shiftright("v", shift + 16) == prefix)
        counts = inside.groupBy(digit.alias("d")).count().toArrow()
        order = np.argsort(counts["d"].to_numpy())[::-1]
        d, n = counts["d"].to_numpy()[order], np.cumsum(counts["count"].to_numpy()[order])
        at = int(np.searchsorted(n, k))
        prefix, k = int(d[at]), k - (int(n[at - 1]) if at else 0)
        shift -= 16
    return prefix


def _keyed(docs: DataFrame, settings: Settings, ratios) -> DataFrame:
    """``docs`` with their log weight and sampling key."""
    weighted = docs.withColumn(WEIGHT, _log_weights(settings, ratios)("text"))
    uniform = (F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    key = F.col(WEIGHT) * settings.sharpness - F.log(-F.log(uniform))
    return weighted.withColumn(KEY, F.round(key * 1_000_000).cast("long"))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """The log ratio of every slot, from counts over all documents."""
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) <> 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
    # A bounded set by its own parameter, hence fit to be broadcast; a hash decides which labels it takes.
    chosen = good.orderBy(F.xxhash64("doc_id", F.lit(settings.seed)), "doc_id").limit(settings.target_rows)
    chosen = chosen.withColumn("target", F.lit(True))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id", "left")
    marked = texts.select("text", F.coalesce("target", F.lit(False)).alias("target"))
    counts = marked.mapInArrow(_counts(settings), "slot int, n long, target long")
    table = counts.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("target").alias("target")).toArrow()
    n, target = np.zeros(settings.slots, dtype=np.int64), np.zeros(settings.slots, dtype=np.int64)
    slot = table["slot"].to_numpy()
    n[slot], target[slot] = table["n"].to_numpy(), table["target"].to_numpy()
    return log_ratios(n, target, settings.deviations, settings.least_ratio)


def _least_key(keyed: DataFrame) -> int | None:
    """The sampling key of the last place; None if the sample is empty."""
    k = keyed.agg(F.round(F.sum(F.exp(WEIGHT))).cast("long")).first()[0] or 0
    return _kth_largest(keyed.filter(F.col(KEY).isNotNull()), KEY, k) if k else None


def resample(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id, log_weight, sampling_key, kept``.

    ``labels(doc_id, quality, toxic)`` marks target texts: quality 1 and toxic not 1. Without any, all weights
    are 1. A text without tokens (null, empty) has a null weight and is rejected. The sampling noise
    follows from ``doc_id``, so repeated rows fare alike and a repeated task gives the same rows; at the last
    place all rows with the same key are kept. Keys are rounded to a millionth.
    """
    ratios = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, settings))
    keyed = cut_lineage(_keyed(docs.select("doc_id", "text"), settings, ratios).select("doc_id", WEIGHT, KEY), "weights")
    kept = F.coalesce(F.col(KEY) >= F.lit(_least_key(keyed)), F.lit(False))
    return keyed.select("doc_id", F.col(WEIGHT).alias("log_weight"), F.col(KEY).alias("sampling_key"), kept.alias("kept"))


def sample(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The sampled rows of ``docs`` with all their columns, as :func:`resample` keeps them.

    Texts are scored a second time in place of a shuffle of all texts.
    """
    ratios = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, settings))
    keyed = cut_lineage(_keyed(docs.select("doc_id", "text"), settings, ratios).select(WEIGHT, KEY), "weights")
    return _keyed(docs, settings, ratios).filter(F.col(KEY) >= F.lit(_least_key(keyed))).drop(WEIGHT, KEY)
