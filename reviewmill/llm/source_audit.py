"""How the sources of a language differ in their words: divergence of term shares, source by source.

Terms are counted by sorting pointers. A task points at the start of every word in the Arrow buffer of its
texts and sorts the pointers by the bytes they point at, eight bytes at a time: pointers with equal
bytes so far are sorted by the next eight, until the words of a run end (multikey quicksort, where numpy's
quicksort does the partitioning). Equal runs are the terms of a slice; their rows give the number of
documents, their sources the counts. No word becomes a Python object before it is a term of a slice.

Counts per language, source and term are summed by Spark. Hot sources, words and documents therefore are
many pointers in many tasks and one row in the sums.

Pairs of sources are compared in blocks of the terms of a language, each a small matrix of shares. The result has a row per ordered pair of sources of a language, as asked for.

Defined results: null language, source or text are empty strings; every row is a document, also one
with a repeated or null id; a source without terms is compared with the smoothed shares of no counts; an
empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import bisect
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm import words
from reviewmill.session import cut_lineage

MIN_DOCUMENTS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
# Shares in the matrix of a block, the sources of a language times some of its terms: about so many, but as
# many terms as sources where there are many of these, so that sums are no more rows than shares.
BLOCK_CELLS, MOST_CELLS = 1 << 14, 1 << 22

# Texts are worked off in slices of about so many bytes; a longer text in windows of that size.
SLICE_BYTES = 1 << 22

# Bytes of words: Latin letters and all of non-ASCII characters.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True

# Masks of a big-endian number that keep its first bytes.
KEPT_BYTES = np.array([((1 << 8 * n) - 1) << (64 - 8 * n) for n in range(9)], dtype=np.uint64)

COUNT_SCHEMA = "lang string, source string, term string, count long, docs long"


def _eight_bytes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes of each word after ``depth`` as one number that sorts like them; zeros after the end.

    ``data`` has eight bytes more than its last word.
    """
    windows = np.ndarray(shape=(len(data) - 7,), dtype=">u8", buffer=data, strides=(1,))
    at = starts + depth
    inside = np.clip(ends - at, 0, 8)
    return windows[np.minimum(at, len(windows) - 1)].astype(np.uint64) & KEPT_BYTES[inside]


def sorted_runs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each word the place of the first word equal to it, in the order of their bytes.

    Words hold no zero byte, so a word that ends sorts before longer ones that begin like it.
    """
    run = np.zeros(len(starts), dtype=np.int64)
    active, depth = np.arange(len(starts)), 0
    while len(active):
        key = _eight_bytes(data, starts[active], ends[active], depth)
        order = np.argsort(key) if depth == 0 else np.lexsort((key, run[active]))
        key, active = key[order], active[order]
        old, places = run[active], np.arange(len(active))
        begins, first = np.ones(len(active), dtype=bool), np.ones(len(active), dtype=bool)
        begins[1:] = old[1:] != old[:-1]
        first[1:] = begins[1:] | (key[1:] != key[:-1])
        # A run is split in its place, so the numbers of later runs stay as they are.
        run[active] = old + np.maximum.accumulate(np.where(first, places, 0)) - np.maximum.accumulate(np.where(begins, places, 0))
        depth += 8
        # A word that ends here may still share its run with a longer one.
        active = active[ends[active] - starts[active] >= depth]
    return run


def _folded(data: np.ndarray) -> np.ndarray:
    return np.concatenate([words.FOLD[data], np.zeros(8, dtype=np.uint8)])


def count_terms(data: np.ndarray, offsets: np.ndarray, groups: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Terms of some texts: their words, and of each the group, the count and the number of texts."""
    data = _folded(data)
    starts, ends, rows = words.spans(data[:-8], offsets, LETTERS)
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return [], none, none, none
    run = sorted_runs(data, starts, ends)
    # Words ordered by term, group and text: one sort of packed numbers.
    by_group = np.argsort(groups, kind="stable")
    rank = np.empty(len(groups), dtype=np.int64)
    rank[by_group] = np.arange(len(groups))
    n = len(groups)
    packed = run * n + rank[rows]
    order = np.argsort(packed)
    packed = packed[order]
    term, text = packed // n, by_group[packed % n]
    group = groups[text]
    new_term = np.ones(len(packed), dtype=bool)
    new_term[1:] = (term[1:] != term[:-1]) | (group[1:] != group[:-1])
    new_text = np.ones(len(packed), dtype=bool)
    new_text[1:] = packed[1:] != packed[:-1]
    first = np.flatnonzero(new_term)
    counts = np.diff(np.append(first, len(packed)))
    docs = np.add.reduceat(new_text.astype(np.int64), first)
    at = order[first]
    raw = data.tobytes()
    return [raw[s:e].decode("utf-8", "replace") for s, e in zip(starts[at].tolist(), ends[at].tolist())], group[first], counts, docs


def _long_text(data: np.ndarray) -> Counter:
    """Counts of the terms of one text, window by window; windows end between words."""
    total: Counter = Counter()
    at = 0
    while at < len(data):
        end = min(at + SLICE_BYTES, len(data))
        while end < len(data) and LETTERS[data[end - 1]] and LETTERS[data[end]]:
            more = np.flatnonzero(~LETTERS[data[end : end + SLICE_BYTES]])
            end = end + int(more[0]) if len(more) else min(end + SLICE_BYTES, len(data))
        part = data[at:end]
        terms, _, counts, _ = count_terms(part, np.array([0, len(part)]), np.zeros(1, dtype=np.int64))
        total.update(dict(zip(terms, counts.tolist())))
        at = end
    return total


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language, source and term of each slice of ``lang, source, text``; one row of each source has no term."""
    for batch in batches:
        names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        codes = {name: code for code, name in enumerate(dict.fromkeys(names))}
        groups, known = np.array([codes[name] for name in names], dtype=np.int64), list(codes)
        langs, sources = pa.array([k[0] for k in known], pa.string()), pa.array([k[1] for k in known], pa.string())
        zero = pa.array(np.zeros(len(known), dtype=np.int64))
        yield pa.record_batch([langs, sources, pa.array([""] * len(known)), zero, zero], names=["lang", "source", "term", "count", "docs"])
        for begin, data, offsets in words.slices(batch.column(2), SLICE_BYTES):
            here = groups[begin : begin + len(offsets) - 1]
            if len(data) > SLICE_BYTES and len(here) == 1:
                total = _long_text(data)
                terms, counts = list(total), np.array(list(total.values()), dtype=np.int64)
                group, docs = np.full(len(terms), here[0]), np.ones(len(terms), dtype=np.int64)
            else:
                terms, group, counts, docs = count_terms(data, offsets, here)
            chosen = pa.array(group.astype(np.int64))
            columns = [langs.take(chosen), sources.take(chosen), pa.array(terms, pa.string()), pa.array(counts), pa.array(docs)]
            yield pa.record_batch(columns, names=["lang", "source", "term", "count", "docs"])


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, count, docs`` over all documents; the empty term stands for the source itself."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    return rows.mapInArrow(_count, COUNT_SCHEMA).groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share_sql(count: str, total: str, terms: str) -> str:
    """The smoothed share of a term in billionths, rounded down; exact beyond 64 bits."""
    wide = [f"cast({c} as decimal(20,0))" for c in (count, total, terms)]
    return f"1 + (cast({SCALE} as decimal(10,0)) * ({wide[0]} + {SMOOTHING})) div ({wide[1]} + {SMOOTHING} * {wide[2]})"


def _distances(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of absolute differences of shares between sources, of blocks of terms.

    Rows ``lang, block, source, term, share`` come block by block; the rows without a term say which sources
    there are and what share they give to a term that they lack.
    """

    def compared(lang: str, rows: pa.Table) -> Iterator[pa.RecordBatch]:
        bases = rows.filter(pc.is_null(rows["term"]))
        entries = rows.filter(pc.is_valid(rows["term"]))
        sources = bases["source"].combine_chunks()
        terms = entries["term"].combine_chunks().dictionary_encode()
        shares = np.repeat(bases["share"].to_numpy()[:, None], len(terms.dictionary), axis=1)
        at = pc.index_in(entries["source"].combine_chunks(), value_set=sources).to_numpy()
        shares[at, terms.indices.to_numpy()] = entries["share"].to_numpy()
        for i in range(len(sources) - 1):
            rest = sources.slice(i + 1)
            one = pa.array([sources[i].as_py()] * len(rest), pa.string())
            value = np.abs(shares[i + 1 :] - shares[i]).sum(axis=1, dtype=np.int64)
            yield pa.record_batch([pa.array([lang] * len(rest), pa.string()), one, rest, pa.array(value)], names=["lang", "source", "item", "value"])

    current, held = None, []
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        low = 0
        while low < len(keys):
            if keys[low] != current:
                if held:
                    yield from compared(current[0], pa.Table.from_batches(held))
                current, held = keys[low], []
            # Rows of a block are neighbours.
            high = bisect.bisect_right(keys, False, low, key=lambda k: k != current)
            held.append(batch.slice(low, high - low))
            low = high
    if held:
        yield from compared(current[0], pa.Table.from_batches(held))


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source is from the others, and by which terms.

    Part ``pair``: the other sources of the language by the sum, over the terms that the language keeps, of the
    differences of shares. Part ``term``: the ``top`` terms that the source uses more than its language does.
    """
    counts = cut_lineage(term_counts(docs), "term-counts")
    found = counts.filter("term <> ''")
    kept = found.groupBy("lang", "term").agg(F.sum("count").alias("lang_count"), F.sum("docs").alias("lang_docs"))
    kept = cut_lineage(kept.filter(F.col("lang_docs") >= min_documents).select("lang", "term", "lang_count"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("lang_count").alias("lang_total"))
    entries = cut_lineage(found.join(kept, ["lang", "term"]).select("lang", "source", "term", "count", "lang_count"), "kept-counts")
    totals = entries.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    present = counts.filter("term = ''").select("lang", "source")
    groups = present.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0, ["total", "n_terms", "lang_total"])
    groups = groups.join(present.groupBy("lang").agg(F.count("*").alias("n_sources")), "lang")
    terms = f"greatest(1, least({MOST_CELLS} / n_sources, greatest(n_sources, {block_cells} / n_sources)))"
    blocks = f"greatest(1L, cast(ceil(n_terms / {terms}) as bigint))"
    # Without kept terms there is no share of an absent one.
    groups = groups.select("*", F.expr(blocks).alias("blocks"), F.expr(f"if(n_terms = 0, 0L, {share_sql('0', 'total', 'greatest(1, n_terms)')})").alias("base"))
    groups = cut_lineage(groups, "sources")

    shares = entries.join(groups, ["lang", "source"]).withColumn("share", F.expr(share_sql("count", "total", "n_terms")))
    excess = (F.col("share") - F.expr(share_sql("lang_count", "lang_total", "n_terms"))).alias("value")
    terms = shares.select("lang", "source", F.col("term").alias("item"), excess).filter("value > 0")

    in_blocks = shares.select("lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "source", "term", "share")
    bases = groups.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", F.lit(None).cast("string").alias("term"), F.col("base").alias("share"))
    dealt = in_blocks.union(bases).repartition("lang", "block").sortWithinPartitions("lang", "block", "term", "source")
    sums = dealt.mapInArrow(_distances, "lang string, source string, item string, value long").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    sums = cut_lineage(sums, "distances")
    pairs = sums.union(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))

    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))

    def part(df: DataFrame, name: str) -> DataFrame:
        return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", place.alias("rank"))

    return part(pairs, "pair").union(part(terms, "term").filter(F.col("rank") <= top))
