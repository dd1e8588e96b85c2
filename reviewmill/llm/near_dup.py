"""Near-duplicate documents: consistent weighted sampling over TF-IDF word shingles.

1. Document frequencies of shingles are counted over all documents in a table of fixed size, indexed
   by a hash of the shingle. The background of an entry is (shingles per document) / (entries) of
   all documents, whatever their number, so weights behave alike at every size.
2. Improved consistent weighted sampling draws ``bands x rows`` samples per document. Documents with
   equal shingle counts are one class from here on.
3. Classes that agree in a band are candidates: each against the most central class of its bucket, the
   one that has most company over all bands.
4. Candidates are verified by the weighted Jaccard similarity of their whole texts.
5. Buckets that still hold several components are worked off further, without losing a pair: small ones pair by
   pair across components. The members of crowded ones are listed under their rarest shingles, as many as a
   text cannot differ in from a similar one (prefix filter): similar texts meet in a list for certain. Where
   thousands of half-similar texts meet, such lists are short, as what the texts share is frequent.
   Each list of several components is compared pair by pair across them, without those that can have no partner in it.
6. Links found in step 5 join components, so only the links between components are followed again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import words
from reviewmill.llm.components import connected_components
from reviewmill.session import cut_lineage

# Rows of the table that the random variates of the sampling come from, chosen by bits of the shingle.
VARIATES = 1 << 15
# A bucket of up to this many classes is worked off pair by pair, a larger one by lists of rare shingles.
SMALL_BUCKET = 16
# A longer list is worked off in cells of pairs of slices.
WHOLE_LIST = 1024
# Sums of weights in another order may differ by rounding.
ROUNDING = 1e-6


@dataclass(frozen=True)
class Settings:
    """``shingle`` words per shingle; ``slots`` entries of the frequency table (4 bytes each, broadcast)."""

    shingle: int = 5
    threshold: float = 0.8
    bands: int = 14
    rows: int = 4
    slots: int = 1 << 20
    seed: int = 17


def _frequencies(settings: Settings):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, documents = words.Tally(settings.slots), 0
        for batch in batches:
            for _, n, keys, rows, _ in words.shingle_sets(batch.column(0), settings.shingle):
                tally.add(keys % np.uint64(settings.slots))
                documents += n
        total = tally.counts()
        used = np.flatnonzero(total)
        slot = np.append(used, -1).astype(np.int32)
        n = np.append(total[used], documents).astype(np.int64)
        for low in range(0, len(slot), 1 << 16):
            yield pa.record_batch([pa.array(slot[low : low + (1 << 16)]), pa.array(n[low : low + (1 << 16)])], names=["slot", "n"])

    return count


def document_frequencies(docs: DataFrame, settings: Settings) -> np.ndarray:
    """The idf factor per entry, between 1 and 2: ``1 + ln((n + 1) / (df + 1)) / ln(slots)``, held to that range.

    What comes to the driver has at most ``slots`` entries, however many documents there are.
    """
    counts = docs.select("text").mapInArrow(_frequencies(settings), "slot int, n long")
    table = counts.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    slot, n = table["slot"].to_numpy(), table["n"].to_numpy()
    documents = int(n[slot == -1].sum())
    frequency = np.zeros(settings.slots)
    frequency[slot[slot >= 0]] = n[slot >= 0]
    idf = 1 + np.log((documents + 1) / (frequency + 1)) / np.log(settings.slots)
    return np.clip(idf, 1, 2).astype(np.float32)


_tables: dict[tuple, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}


def _variates(settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gamma(2, 1) scales, logs of Gamma(2, 1) values and uniform shifts, one row per kind of shingle."""
    key = (settings.seed, settings.bands * settings.rows)
    if key not in _tables:
        draw, shape = np.random.default_rng(settings.seed), (VARIATES, key[1])
        _tables.clear()
        _tables[key] = (
            draw.gamma(2.0, size=shape).astype(np.float32),
            np.log(draw.gamma(2.0, size=shape)).astype(np.float32),
            draw.random(shape, dtype=np.float32),
        )
    return _tables[key]


def samples(keys: np.ndarray, weights: np.ndarray, starts: np.ndarray, settings: Settings) -> np.ndarray:
    """One row per document (whose shingles begin at ``starts``) with a 64-bit value per sample.

    For every shingle the weight is rounded down to a random step of a geometric grid; the shingle with
    the smallest draw is the sample, together with its step. Two documents agree in a sample with the
    probability of their weighted Jaccard similarity.
    """
    scale, log_c, shift = _variates(settings)
    k = scale.shape[1]
    out = np.empty((len(starts), k), dtype=np.uint64)
    ends = np.append(starts[1:], len(keys))
    kind = ((keys >> np.uint64(24)) % np.uint64(VARIATES)).astype(np.int64)
    log_w = np.log(weights).astype(np.float32)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + 4096, side="right")))
        best_value, best_key, best_step = None, None, None
        # A document with many shingles is worked off in pieces.
        for low in range(int(starts[at]), int(ends[to - 1]), 1 << 13):
            high = min(low + (1 << 13), int(ends[to - 1]))
            begin = np.array([low]) if to == at + 1 else starts[at:to] - low
            r, b = scale[kind[low:high]], shift[kind[low:high]]
            step = np.floor(log_w[low:high, None] / r + b)
            value = log_c[kind[low:high]] - r * (step - b + 1)
            least = np.minimum.reduceat(value, begin - (low if to == at + 1 else 0), axis=0)
            owner = np.zeros(high - low, dtype=np.int64)
            owner[(begin - (low if to == at + 1 else 0))[1:]] = 1
            owner = np.cumsum(owner)
            row, column = np.nonzero(value == least[owner])
            row, column = row[::-1], column[::-1]  # of equal draws the first shingle stays
            key, at_step = np.zeros(least.shape, dtype=np.uint64), np.zeros(least.shape, dtype=np.int64)
            key[owner[row], column] = keys[low + row]
            at_step[owner[row], column] = step[row, column].astype(np.int64)
            if best_value is None:
                best_value, best_key, best_step = least, key, at_step
            else:
                better = least < best_value
                best_value, best_key, best_step = (
                    np.where(better, x, y) for x, y in ((least, best_value), (key, best_key), (at_step, best_step))
                )
        out[at:to] = words.mix(best_key * np.uint64(0x9E3779B97F4A7C15) + best_step.view(np.uint64))
        at = to
    return out


def _signatures(settings: Settings, idf_table):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = idf_table.value
        for batch in batches:
            ids = batch.column(0)
            for begin, n, keys, rows, counts in words.shingle_sets(batch.column(1), settings.shingle):
                present, starts = np.unique(rows, return_index=True)
                weights = counts * idf[(keys % np.uint64(settings.slots)).astype(np.int64)]
                bands = np.zeros((n, settings.bands), dtype=np.int64)
                prints = np.zeros((n, 2), dtype=np.int64)
                if len(keys):
                    drawn = samples(keys, weights, starts, settings)
                    for j in range(settings.bands):
                        band = np.zeros(len(present), dtype=np.uint64)
                        for i in range(settings.rows):
                            band = words.mix(band * np.uint64(31) + drawn[:, j * settings.rows + i] + np.uint64(i + 1))
                        bands[present, j] = band.view(np.int64)
                    entry = keys * np.uint64(0x9E3779B97F4A7C15) + counts.astype(np.uint64)
                    for i in range(2):
                        prints[present, i] = np.add.reduceat(words.seeded(entry, i), starts).view(np.int64)
                empty = np.ones(n, dtype=bool)
                empty[present] = False
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, (n + 1) * settings.bands, settings.bands, dtype=np.int32)), pa.array(bands.ravel())
                )
                yield pa.record_batch(
                    [ids.slice(begin, n), pa.array(prints[:, 0]), pa.array(prints[:, 1]), pa.array(empty), lists],
                    names=["doc_id", "print_a", "print_b", "empty", "bands"],
                )

    return sign


def _rarest(settings: Settings, idf_table):
    """Per text the shingles of which a similar text has one at least: the rarest, up to where what is left weighs too little.

    Shingles of all texts are in one order, by falling weight. If two texts have no shingle of their beginnings
    in common, then what they share is in the rest of one of them, and weighs less than the threshold of all of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = idf_table.value
        for batch in batches:
            for begin, n, keys, rows, counts in words.shingle_sets(batch.column(1), settings.shingle):
                rarity = idf[(keys % np.uint64(settings.slots)).astype(np.int64)].astype(np.float64)
                order = np.lexsort((words.seeded(keys, 11), -rarity, rows))
                keys, row, weight = keys[order], rows[order], (counts * rarity)[order]
                total = np.bincount(row, weights=weight, minlength=n)
                before = np.cumsum(weight) - weight
                present, starts = np.unique(row, return_index=True)
                first = np.zeros(n)
                first[present] = before[starts]
                rest = total[row] - (before - first[row])
                kept = rest >= settings.threshold * (1 - ROUNDING) * total[row]
                row = row[kept]
                ids = batch.column(0).slice(begin, n).take(pa.array(row))
                columns = [ids, pa.array(total[row]), pa.array(rest[kept]), pa.array(keys[kept].view(np.int64))]
                yield pa.record_batch(columns, names=["rep", "weight", "rest", "key"])

    return run


def _verify(settings: Settings, idf_table):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf = idf_table.value
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                n = part.num_rows
                sets = [(k, r + b, c) for i in (2, 3) for b, _, k, r, c in words.shingle_sets(part.column(i), settings.shingle)]
                key, row, count = (np.concatenate(x) for x in zip(*sets))
                weight = count * idf[(key % np.uint64(settings.slots)).astype(np.int64)].astype(np.float64)
                packed = (row.astype(np.uint64) << np.uint64(48)) | key
                order = np.argsort(packed, kind="stable")
                packed, row, weight = packed[order], row[order], weight[order]
                both = packed[1:] == packed[:-1]
                shared = np.bincount(row[1:][both], weights=np.minimum(weight[1:], weight[:-1])[both], minlength=n)
                total = np.bincount(row, weights=weight, minlength=n)
                similarity = shared / np.maximum(total - shared, 1e-300)
                linked = pa.array(np.flatnonzero(similarity >= settings.threshold - 1e-9))
                yield pa.record_batch([part.column(0).take(linked), part.column(1).take(linked)], names=["a", "b"])

    return verify


def verified(pairs: DataFrame, texts: DataFrame, settings: Settings, idf_table) -> DataFrame:
    """Those of ``pairs(a, b)`` that are similar."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_verify(settings, idf_table), "a long, b long")


def _labelled(rows: DataFrame, components: DataFrame) -> DataFrame:
    return rows.join(components, rows.rep == components.node, "left").withColumn("component", F.coalesce("component", "rep")).drop("node")


def _between(links: DataFrame, components: DataFrame) -> DataFrame:
    """``links(a, b)`` as links between the components of their ends."""
    for end in ("a", "b"):
        links = links.join(components.select(F.col("node").alias(end), F.col("component").alias("_c")), end, "left")
        links = links.withColumn(end, F.coalesce("_c", end)).select("a", "b")
    return links


def _united(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with the ``component`` that theirs becomes by ``links(a, b)`` between components."""
    wider = connected_components(links).select(F.col("node").alias("component"), F.col("component").alias("_wider"))
    return rows.join(wider, "component", "left").withColumn("component", F.coalesce("_wider", "component")).drop("_wider")


def _stars(entries: DataFrame) -> DataFrame:
    """Each member of a bucket with the most central one; ``entries(rep, key, company)``."""
    central = F.max_by("rep", F.struct("company", -F.col("rep"))).alias("leader")
    buckets = entries.groupBy("key").agg(central, F.count("*").alias("n")).filter("n > 1").drop("n")
    pairs = entries.join(buckets, "key").filter("rep <> leader")
    return pairs.select(F.least("leader", "rep").alias("a"), F.greatest("leader", "rep").alias("b")).distinct()


def _mixed(entries: DataFrame) -> DataFrame:
    """Buckets of ``entries(key, component)`` that hold several components, with their size."""
    sizes = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    return sizes.filter("low < high").select("key", "n")


def _across(entries: DataFrame) -> DataFrame:
    """Pairs of different components in the same bucket; ``entries(rep, key, component)``."""
    other = entries.select("key", F.col("rep").alias("b"), F.col("component").alias("other"))
    return entries.join(other, "key").filter("rep < b AND component <> other").select(F.col("rep").alias("a"), "b").distinct()


def _possible(threshold: float) -> Column:
    """Whether two classes can be similar that have a rare shingle in common, and none before it.

    They share at most what is left of either from that shingle on, ``rest`` and ``rest_b``. A pair that fails
    at a later shingle of both is judged at the first one, too.
    """
    needed = (F.col("weight") + F.col("weight_b")) * (threshold / (1 + threshold) * (1 - ROUNDING))
    return F.least("rest", "rest_b") >= needed


def _compared(lists: DataFrame, threshold: float) -> DataFrame:
    """Those entries of lists of several components that may have a partner in the list, with ``n`` entries of the list.

    Of two similar texts the lighter one has at least as much left as two of its weight need (``leading``). So an entry
    has no partner where it cannot be similar to the lightest of these.
    """
    needed = threshold / (1 + threshold) * (1 - ROUNDING)
    marked = lists.withColumn("leading", F.col("rest") >= (F.col("weight") + F.col("weight")) * needed)
    sizes = marked.groupBy("key").agg(
        F.count("*").alias("n"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.min(F.when(F.col("leading"), F.col("weight"))).alias("lightest"),
    )
    both = marked.join(sizes.filter("low < high AND lightest IS NOT NULL").select("key", "n", "lightest"), "key")
    return both.filter(F.col("rest") >= (F.col("weight") + F.col("lightest")) * needed).drop("lightest", "leading")


def _cells(lists: DataFrame) -> DataFrame:
    """The entries of each list in cells ``x, y`` of pairs of slices: any two entries meet in a cell.

    The number of slices grows with the square root of the list, so an entry is sent no more than that many times.
    """
    slices = F.greatest(F.lit(1), F.ceil(F.sqrt(F.col("n") / WHOLE_LIST))).cast("int")
    placed = lists.withColumn("slices", slices).withColumn("at", F.pmod(F.xxhash64("rep"), F.col("slices")).cast("int"))
    cells = placed.withColumn("to", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    return cells.select("key", F.least("at", "to").alias("x"), F.greatest("at", "to").alias("y"), "rep", "weight", "rest", "component")


def _pairs_of_lists(lists: DataFrame, threshold: float) -> DataFrame:
    """All pairs of different components in lists of any length that can be similar; ``lists(rep, weight, rest, key, component, n)``.

    A long list is worked off cell by cell, so no task has all of it.
    """
    cells = _cells(lists)
    renamed = [F.col(c).alias(f"{c}_b") for c in ("weight", "rest", "component")]
    other = cells.select("key", "x", "y", F.col("rep").alias("b"), *renamed)
    apart = (F.col("rep") < F.col("b")) & (F.col("component") != F.col("component_b"))
    pairs = cells.join(other, ["key", "x", "y"]).filter(apart & _possible(threshold))
    return pairs.select(F.col("rep").alias("a"), "b").distinct()


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per document: ``doc_id, class_id, kept``.

    ``docs`` has ``doc_id`` (long) and ``text``; other columns are ignored. ``class_id`` is the smallest
    ``doc_id`` reachable over links (equal shingle counts, or weighted similarity of at least the
    threshold), ``kept`` says whether the document is that one. A text without words (null, empty)
    links with nothing; a null ``doc_id`` is kept with a null class. Rows that repeat a ``doc_id`` give
    one row each.
    """
    spark: SparkSession = docs.sparkSession
    docs = docs.select("doc_id", "text")
    idf_table = spark.sparkContext.broadcast(document_frequencies(docs, settings))
    schema = "doc_id long, print_a long, print_b long, empty boolean, bands array<long>"
    signed = cut_lineage(docs.mapInArrow(_signatures(settings, idf_table), schema), "signatures")
    usable = signed.filter("NOT empty AND doc_id IS NOT NULL")
    classes = usable.groupBy("print_a", "print_b").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands")
    )
    classes = cut_lineage(classes, "classes")
    entries = classes.select("rep", F.posexplode("bands").alias("band", "value")).select(
        "rep", F.xxhash64("band", "value").alias("key")
    )
    sizes = entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    # One row per class with its at most ``bands`` buckets.
    shared = entries.join(sizes, "key").groupBy("rep").agg(F.sum("n").alias("company"), F.collect_list("key").alias("keys"))
    shared = cut_lineage(shared, "buckets")
    tested = cut_lineage(_stars(shared.select("rep", "company", F.explode("keys").alias("key"))), "pairs")
    links = cut_lineage(verified(tested, docs, settings, idf_table), "verified")
    components = cut_lineage(connected_components(links), "components")

    members = _labelled(shared, components).select("rep", "component", F.explode("keys").alias("key"))
    members = cut_lineage(members.join(_mixed(members), "key"), "mixed")
    pairs = _across(members.filter(f"n <= {SMALL_BUCKET}"))
    crowded = members.filter(f"n > {SMALL_BUCKET}").select("rep", "component").distinct()
    if not crowded.isEmpty():
        chosen = docs.select(F.col("doc_id").alias("rep"), "text").join(crowded, "rep", "left_semi")
        lists = chosen.mapInArrow(_rarest(settings, idf_table), "rep long, weight double, rest double, key long")
        lists = cut_lineage(lists, "lists").join(crowded, "rep")
        compared = cut_lineage(_compared(lists, settings.threshold), "compared")
        pairs = pairs.union(_pairs_of_lists(compared, settings.threshold)).distinct()
    by_class = _labelled(classes.select("print_a", "print_b", "rep"), components)
    new = cut_lineage(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
    if not new.isEmpty():
        found = cut_lineage(verified(new, docs, settings, idf_table), "verified")
        by_class = _united(by_class, _between(found, components))
    by_class = by_class.select("print_a", "print_b", "component")
    found = usable.select("doc_id", "print_a", "print_b").join(by_class, ["print_a", "print_b"])
    left_over = signed.filter("empty OR doc_id IS NULL").select("doc_id", F.col("doc_id").alias("class_id"))
    result = found.select("doc_id", F.col("component").alias("class_id")).union(left_over)
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One document of each class, the one with the smallest ``doc_id``, with its columns.

    Of rows that repeat a ``doc_id`` one stays; rows without one stay all.
    """
    dropped = near_duplicates(docs, settings).filter("NOT kept").select("doc_id").distinct()
    named = docs.filter("doc_id IS NOT NULL").join(dropped, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    return named.select(*docs.columns).unionAll(docs.filter("doc_id IS NULL"))
