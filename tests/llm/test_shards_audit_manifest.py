"""Shards, source audit and manifest against plain Python."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from edge import prose
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewmill.llm import merkle, sharding, source_audit, words

ROWS = [
    (1, prose(1, 120), "en", "a", 5),
    (2, prose(1, 120), "en", "a", 5),
    (3, prose(2, 90) + "\n" + prose(3, 10), "en", "b", None),
    (4, None, "en", None, 7),
    (5, "", None, "b", 0),
    (6, "Mörder, ÄRGER und ärger; mörder!", "de", "a", 3),
    (7, "Mörder Ärger", "de", "c", 3),
    (8, "zu zu zu", "de", "", 1),
    (9, prose(99, 6000), "en", "c", 9),
    (9, "another text of the same id", "en", "c", 9),
    (10, "same", "fr", "a", 1),
    (10, "same", "fr", "a", 1),
    (None, "same", "fr", "a", 1),
    (-3, "x\ny\n", "en", "b", 2),
    (30, "1234 5678", "es", "a", 2),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows=ROWS):
    """With extra columns whose names the operators use themselves."""
    extra = {n: F.lit(1) for n in ("size", "shard", "digest", "key", "grp", "i", "n", "term", "count", "value", "path", "row")}
    return spark.createDataFrame(rows, SCHEMA).withColumns(extra).repartition(3)


def copies(n: int) -> list[tuple]:
    """A third of the rows with one text and source, the rest all different."""
    return [(i, prose(7, 30) if i % 3 == 0 else prose(i + 100, 5 + i % 40), "en", "hot" if i % 3 == 0 else f"s{i % 5}", i) for i in range(n)]


# Shards


def greedy(sizes: dict[bytes, int], shards: int) -> dict[bytes, int]:
    heap, out = [(0, s) for s in range(shards)], {}
    for digest, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        load, shard = heapq.heappop(heap)
        out[digest] = shard
        heapq.heappush(heap, (load + size, shard))
    return out


def check_shards(rows, found, shards):
    assert sorted((r.key, r.size, r.text_crc32) for r in found.itertuples()) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    )
    assert found.groupby(["size", "text_crc32"]).shard.nunique().max() == 1
    for _, part in found.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert found.shard.between(0, shards - 1).all()


@pytest.mark.parametrize("rows", [[r for r in ROWS if r[0] is not None], copies(400)], ids=["edge", "hot"])
def test_shards_are_the_plain_schedule(spark, rows):
    found = sharding.shard_documents(table(spark, rows), 4, precision=1 << 20).toPandas()
    check_shards(rows, found, 4)
    sizes: Counter = Counter()
    for _, text, *_ in rows:
        sizes[hashlib.sha256((text or "").encode()).digest()] += len((text or "").encode()) + 1
    expected = greedy(sizes, 4)
    where = {(len((t or "").encode()) + 1, zlib.crc32((t or "").encode())): expected[hashlib.sha256((t or "").encode()).digest()] for _, t, *_ in rows}
    assert all(where[r.size, r.text_crc32] == r.shard for r in found.itertuples())


def test_small_groups_go_in_bundles(spark):
    rows = copies(900)
    found = sharding.shard_documents(table(spark, rows), 3, precision=8, buckets=4).toPandas()
    check_shards(rows, found, 3)
    loads = found.groupby("shard")["size"].sum()
    total = int(loads.sum())
    # The copies are one group of more than a shard's part; the other two shards are even.
    hot = found[found["size"] == found["size"].mode()[0]].shard.mode()[0]
    rest = loads.drop(hot)
    assert rest.max() - rest.min() <= 2 * total / (3 * 8)


def test_shards_null_ids_and_no_rows(spark):
    found = sharding.shard_documents(table(spark), 8).toPandas()
    assert len(found) == len(ROWS) and found.key.isna().sum() == 1
    assert found.groupby(["size", "text_crc32"]).shard.nunique().max() == 1
    assert sharding.shard_documents(table(spark, []), 8).count() == 0


# Source audit


def audited(rows, least, top):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", text or "")]
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in {k[0] for k in counts}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        sources = [s for g, s in counts if g == lang]
        total = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 5) // (total[s] + 5 * len(kept)) for t in kept} for s in sources}
        whole = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        q = {t: 1 + 10**9 * (whole[t] + 5) // (sum(whole.values()) + 5 * len(kept)) for t in kept}
        for s in sources:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:limit], 1):
                    out.append((lang, s, part, item, value, rank))
    return sorted(out)


@pytest.mark.parametrize("rows", [ROWS, copies(300)], ids=["edge", "hot"])
@pytest.mark.parametrize("cells", [1 << 22, 24])
def test_audit(spark, rows, cells):
    found = source_audit.audit(table(spark, rows), min_documents=2, top=7, block_cells=cells)
    assert sorted(tuple(r) for r in found.collect()) == audited(rows, 2, 7)


def test_audit_without_kept_terms_or_rows(spark):
    rows = [(1, "a b", "en", "x", 1), (2, None, "en", "y", 1)]
    found = source_audit.audit(table(spark, rows)).collect()
    assert sorted(tuple(r) for r in found) == [("en", "x", "pair", "y", 0, 1), ("en", "y", "pair", "x", 0, 1)]
    assert source_audit.audit(table(spark, [])).count() == 0


def test_shares_beyond_64_bits(spark):
    n, total, terms = 10**15, 10**17 + 3, 10**7
    row = spark.sql(f"SELECT {n}L AS c, {total}L AS t, {terms}L AS v").select(F.expr(source_audit.share_sql("c", "t", "v"))).first()
    assert row[0] == 1 + 10**9 * (n + 5) // (total + 5 * terms)


@settings(deadline=None, max_examples=100)
@given(st.lists(st.text("abcé", min_size=1, max_size=30), min_size=1, max_size=60))
def test_equal_words_are_runs(many):
    raw = [w.encode() for w in many]
    data = np.frombuffer(b" ".join(raw) + bytes(8), dtype=np.uint8)
    sizes = np.array([len(w) for w in raw])
    starts = np.cumsum(sizes + 1) - sizes - 1
    run = source_audit.sorted_runs(data, starts, starts + sizes)
    order = sorted(raw)
    assert run.tolist() == [order.index(w) for w in raw]


def test_long_texts_in_windows(monkeypatch):
    text = (prose(5, 400) + " " + "x" * 500 + " Ünder").encode()
    monkeypatch.setattr(source_audit, "SLICE_BYTES", 64)
    found = source_audit._long_text(np.frombuffer(text, dtype=np.uint8))
    expected = Counter(words.FOLD[np.frombuffer(w, dtype=np.uint8)].tobytes().decode() for w in re.findall(rb"[A-Za-z\x80-\xff]+", text))
    assert found == expected


# Manifest


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(nodes):
    out = [list(nodes)]
    while len(out[-1]) > 1:
        out.append([h(out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def proof(levels, i):
    out = []
    for level in levels[:-1]:
        run = i - i % 3
        out.append((level[run:i], level[i + 1 : run + 3]))
        i //= 3
    return out


def leaf_of(doc_id, text, lang, source, n_chars):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text))


def manifest(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append((row[0], leaf_of(*row)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels_of([x[1] for x in sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))]) for s in names}
    top = levels_of([trees[s][-1][0] for s in names])
    out = []
    for place, s in enumerate(names):
        for i, (doc_id, leaf) in enumerate(sorted(groups[s], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))):
            path = proof(trees[s], i) + proof(top, place)
            out.append((doc_id, s, i, leaf, trees[s][-1][0], top[-1][0], [("".join(a), "".join(b)) for a, b in path]))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 4, 8, 9, 10, 26, 27, 28, 82, 100])
def test_positions_are_postorder(n):
    height, place, sizes = merkle.height(n), [0], [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // 3))

    def visit(level, index):
        if level:
            for child in range(3 * index, min(3 * index + 3, sizes[level - 1])):
                visit(level - 1, child)
        assert merkle.position(level, index, n) == place[0]
        place[0] += 1

    visit(height, 0)
    assert place[0] == sum(sizes)


@pytest.mark.parametrize("levels", [1, 2, 7])
def test_proofs(spark, tmp_path, levels):
    rows = ROWS + [(100 + i, f"t{i}", "en", "big", i) for i in range(95)] + [(i, "one", "en", f"only{i}", 1) for i in range(12)]
    merkle.write_manifest(table(spark, rows), str(tmp_path / "m"), block_levels=levels, extra={"upper": F.upper("text")})
    found = merkle.proofs(spark, str(tmp_path / "m"), levels)
    got = [(r.key, r.grp, r.i, r.digest, r.subroot, r.root, [tuple(s) for s in r.path]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(manifest(rows), key=repr)
    checked = found.select("upper", (merkle.folded(F.col("digest"), F.col("path")) == F.col("root")).alias("ok"), (merkle.folded(F.sha2("digest", 256), F.col("path")) == F.col("root")).alias("bad"))
    assert [(r.ok, r.bad) for r in checked.collect()] == [(True, False)] * len(rows)
    assert sorted(r.upper or "" for r in checked.collect()) == sorted((r[1] or "").upper() for r in rows)


def test_log_is_postorder(spark, tmp_path):
    rows = copies(70)
    merkle.write_manifest(table(spark, rows), str(tmp_path / "m"), block_levels=2)
    log = merkle.read_log(spark, str(tmp_path / "m")).toPandas()
    assert len(log.groupby(["tree", "grp"], dropna=False)) == 7
    for (_, _, n), nodes in log.groupby(["tree", "grp", "n"], dropna=False):
        sizes = [n]
        while sizes[-1] > 1:
            sizes.append(-(-sizes[-1] // 3))
        assert sorted(nodes.position) == list(range(sum(sizes)))


def test_manifest_of_one_row_and_of_none(spark, tmp_path):
    merkle.write_manifest(table(spark, ROWS[:1]), str(tmp_path / "one"))
    row = merkle.proofs(spark, str(tmp_path / "one")).first()
    assert row.digest == row.subroot == row.root == leaf_of(*ROWS[0]) and row.path == []
    merkle.write_manifest(table(spark, []), str(tmp_path / "none"))
    assert merkle.proofs(spark, str(tmp_path / "none")).count() == 0
