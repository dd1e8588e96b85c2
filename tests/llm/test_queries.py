"""The registered queries and the pipeline over whole tables, against brute force."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from edge import edited, prose
from test_operators import checked_pieces, whole

import __spark_entry__ as entry
import corpus_pipeline
from reviewmill.llm import packing, pseudonyms, quality
from reviewmill.llm import queries as llm_queries

QUERIES = llm_queries.QUERIES


def read(sf_dir, name):
    return pd.read_parquet(f"{sf_dir}/{name}.parquet")


def test_one_query_for_each_operator():
    names = [n for n in QUERIES if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in QUERIES and set(QUERIES) <= set(entry.queries()) and set(llm_queries.SQL) <= set(entry.oracle_sql())


def test_op2_links(spark, sf_dir):
    found = QUERIES["op2_embedding_duplicates"](spark, sf_dir).toPandas().set_index("vec_id")
    table = read(sf_dir, "embeddings")
    assert len(found) == len(table)
    for _, rows in table.groupby("label"):
        units = np.stack(rows.embedding).astype(float)
        units /= np.linalg.norm(units, axis=1)[:, None]
        links = (units @ units.T >= 0.93).sum(axis=1) - 1
        assert (found.loc[rows.vec_id, "n_links"].to_numpy() == links).all()


def test_op3_files(spark, sf_dir):
    found = QUERIES["op3_token_files"](spark, sf_dir).toPandas().sort_values("doc_id")
    encode, start = whole(public_tokenizers.path("word_bpe_49k.json")), 0
    table = read(sf_dir, "documents").sort_values("doc_id")
    assert len(found) == len(table)
    for row, text in zip(found.itertuples(), table.text):
        ids = encode(text) + [2]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_op5_keeps_good_texts(spark, sf_dir):
    found = QUERIES["op5_quality"](spark, sf_dir).toPandas()
    table = read(sf_dir, "labels").merge(found, on="doc_id")
    assert len(found) == len(read(sf_dir, "documents"))
    assert table[(table.quality == 1) & (table.toxic == 0)].kept.mean() > 0.9


def test_op6_finds_every_passage(spark, sf_dir):
    found = QUERIES["op6_decontamination"](spark, sf_dir).toPandas()
    pairs = set(zip(found.doc_id, found.item_id))
    docs, items = read(sf_dir, "documents"), read(sf_dir, "benchmark")
    whole_ones = {(d, i) for i, t in zip(items.item_id, items.text) for d, x in zip(docs.doc_id, docs.text) if t in x}
    assert whole_ones <= pairs and whole_ones == {(r.doc_id, r.item_id) for r in found.itertuples() if r.edits == 0 and (r.doc_id, r.item_id) in whole_ones}


def test_op7_pieces(spark, sf_dir):
    found = QUERIES["op7_packing"](spark, sf_dir).toPandas()
    encode, padding = whole(public_tokenizers.path("byte_bpe_50k.json")), 0
    docs = read(sf_dir, "documents")
    by_doc = dict(tuple(found.sort_values("start").groupby("doc_id")))
    for doc, text in zip(docs.doc_id, docs.text):
        ids, at = encode(text) + [0], 0
        for piece in by_doc[doc].itertuples():
            assert piece.start == at and piece.doc_tokens == len(ids)
            assert piece.ids_crc32 == zlib.crc32(np.array(ids[at : at + piece.length], "<u4").tobytes())
            at += piece.length
        assert at == len(ids)
    for size in found.groupby("sequence_id").length.sum():
        padding += 0 if size & (size - 1) == 0 else 1024 - size
    assert padding == 0


def test_op8_exact_copies_are_one_class(spark, sf_dir):
    found = QUERIES["op8_near_duplicates"](spark, sf_dir).toPandas()
    table = read(sf_dir, "documents").merge(found, on="doc_id")
    assert len(table) == len(found)
    copies = table.groupby("text").class_id.nunique()
    assert copies.max() == 1 and table.kept.sum() == table.class_id.nunique()


def test_op9_changes_nothing_else(spark, sf_dir):
    found = QUERIES["op9_pseudonyms"](spark, sf_dir).toPandas().merge(read(sf_dir, "documents"), on="doc_id")
    known = pseudonyms.Pseudonyms(corpus_pipeline.PSEUDONYM_KEY)
    for row in found.itertuples():
        assert len(row.text_x) == len(row.text_y)
        assert (row.text_x, row.n_values) == known.replace(row.text_y)
        assert not re.search(r"\b[0-9]{16}\b", row.text_y) or row.text_x != row.text_y


def test_op10_counts(spark, sf_dir):
    found = QUERIES["op10_language_model"](spark, sf_dir).toPandas().set_index("doc_id")
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    docs = read(sf_dir, "documents")
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(small)) + [None] for d, t in zip(docs.doc_id, docs.text)}
    held = {d for d in words if zlib.crc32(str(d).encode()) % 10 == 0}
    counts = Counter(w for d, ws in words.items() if d not in held for w in ws)
    n, v = sum(counts.values()), len(counts)
    for d, ws in words.items():
        row = found.loc[d]
        assert (row.n_tokens, row.n_known, row.train_tokens, row.held_out) == (len(ws), sum(counts[w] > 0 for w in ws), n, d in held)
        assert row.base_score == pytest.approx(sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), rel=1e-9)
    assert found.score.sum() > found.base_score.sum()


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents, and one of each kind that a stage has to catch."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    passage = prose(900, 40)
    rows = {i: prose(i + 1000, 70) for i in range(240)}
    rows |= {i: " ".join(w + "###" for w in prose(i + 1000, 60).split()) for i in range(240, 300)}
    rows |= {300: rows[0], 301: edited(rows[1], [30]), 302: rows[2] + " " + passage, 303: rows[3][:200] + " call +1 (212) 555-0101 or a.12@mail1.example.com"}
    rows |= {304: prose(77, 20) + " " + passage.upper(), 305: None, 306: ""}
    labels = [(i, int(i < 240), 0) for i in range(0, 300, 2)]
    docs = [(i, t, "en", "s", len(t or "")) for i, t in rows.items()]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows


def test_pipeline_stage_by_stage(spark, corpus):
    folder, rows = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        if name != "packing":
            assert docs.columns == columns
            docs.write.parquet(f"{folder}/{name}")
            docs = spark.read.parquet(f"{folder}/{name}")
            kept.append({r.doc_id: r.text for r in docs.collect()})
    good, distinct, clean, private = kept
    assert not set(range(240, 300)) & set(good) and not {305, 306} & set(good)
    assert len(set(range(240)) & set(good)) >= 236
    assert set(good) - set(distinct) == {i for i, original in ((300, 0), (301, 1)) if i in good and original in good}
    assert set(distinct) - set(clean) == {302, 304} & set(distinct)
    known = pseudonyms.Pseudonyms(corpus_pipeline.PSEUDONYM_KEY)
    assert private == {i: known.replace(rows[i])[0] for i in clean}
    pieces = docs.collect()
    padding, _ = checked_pieces(pieces, list(private.items()), packing.Limits(), [0])
    assert padding == 0
    again = corpus_pipeline.run(spark, folder).collect()
    place = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert {r[0] for r in map(place, again)} == set(private)
    assert sum(r.length for r in again) == sum(r.length for r in pieces)


def test_pipeline_of_empty_tables(spark, corpus, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{corpus[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_op11_shards(spark, sf_dir):
    found = QUERIES["op11_shards"](spark, sf_dir).toPandas()
    docs = read(sf_dir, "documents")
    sizes = docs.text.map(lambda t: len(t.encode()) + 1)
    expected = {i: (s, zlib.crc32(t.encode())) for i, s, t in zip(docs.doc_id, sizes, docs.text)}
    assert {r.doc_id: (r.size, r.text_crc32) for r in found.itertuples()} == expected and len(found) == len(docs)
    assert found.merge(docs[["doc_id", "text"]], on="doc_id").groupby("text").shard.nunique().max() == 1
    loads = found.groupby("shard")["size"].sum()
    assert len(loads) == 8 and loads.max() - loads.min() < 0.01 * loads.mean()
    for _, part in found.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))


def test_op5_weights_and_places(spark, sf_dir):
    """Models counted text by text, weights summed in plain Python, and the sample as the head of a sorted list."""
    settings = quality.Settings()
    found = QUERIES["op5_quality"](spark, sf_dir).toPandas().set_index("doc_id")
    docs, labels = read(sf_dir, "documents"), read(sf_dir, "labels")
    good = set(labels[(labels.quality == 1) & (labels.toxic.fillna(0) != 1)].doc_id)
    grams = {}
    for doc_id, text in zip(docs.doc_id, docs.text):
        grams[doc_id] = [tuple(pair) for _, _, slot, _ in quality._ngrams(pa.array([text]), settings.slots) for pair in slot.T.tolist()]
    every, target = Counter(), Counter()
    for doc_id, pairs in grams.items():
        every.update(s for pair in pairs for s in pair)
        if doc_id in good:
            target.update(s for pair in pairs for s in pair)
    # The rate at which half of all n-grams, by count, have a smaller share of target texts.
    shares, half, upto = sorted((target[s] / n, n) for s, n in every.items()), sum(every.values()) / 2, 0
    for rate, n in shares:
        upto += n
        if upto >= half:
            break

    def ratio(slot):
        n, t = every[slot], target[slot]
        expected, spread = n * rate, settings.deviations * math.sqrt(t + 1)
        if t < expected:
            value = min(math.log((t + spread) / expected), 0)
        else:
            value = max(math.log(max(t - spread, 1e-12) / expected), 0)
        return 0.0 if abs(value) < math.log(settings.least_ratio) else value

    weights = {}
    for doc_id, pairs in grams.items():
        total = 0.0
        for pair in pairs:
            a, b = ratio(pair[0]), ratio(pair[1])
            if a * b > 0:
                total += a if abs(a) < abs(b) else b
        weights[doc_id] = min(total, 0.0)
    assert found.log_weight.to_dict() == pytest.approx(weights, rel=1e-4, abs=1e-4)
    k = round(sum(math.exp(w) for w in found.log_weight))
    last = sorted(found.sampling_key, reverse=True)[k - 1]
    assert ((found.sampling_key >= last) == found.kept).all()
