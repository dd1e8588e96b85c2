"""The registered queries of the training-data operators, with SQL where SQL can express one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from reviewmill.llm import (
    chat,
    decontaminate,
    embedding_dup,
    language_model,
    licenses,
    merkle,
    near_dup,
    packing,
    pseudonyms,
    quality,
    sharding,
    source_audit,
    token_files,
    tokens,
)
from reviewmill.session import cut_lineage, scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_licenses", licenses.recognize_sql())
def op1_licenses(spark, sf_dir):
    """Known license sentences of every document and the license they mean."""
    return licenses.recognize(table(spark, sf_dir, "documents"))


@query("op2_embedding_duplicates")
def op2_embedding_duplicates(spark, sf_dir):
    """Links and component of every vector."""
    return embedding_dup.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op3_token_files")
def op3_token_files(spark, sf_dir):
    """Token files of all documents, read back: place, number and checksum of each document's ids."""
    path = scratch_path(spark, "token-files")
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary, tokens.split_at_space, end_id=2)
    read = token_files.read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
rendered AS (
  SELECT *, row_number() OVER () AS row_id, length('<|turn|>' || '<|text|>' || '<|end|>'
    || replace(replace(role, '\', '\\'), '<|', '<\|') || replace(replace(text, '\', '\\'), '<|', '<\|')) AS chars
  FROM turns),
joined AS (
  SELECT conv_id, CASE WHEN conv_id IS NULL THEN row_id END AS single, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         CAST(sum(chars) AS BIGINT) AS formatted_chars
  FROM rendered GROUP BY conv_id, single)
SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM joined"""


@query("op4_chat_format", CHAT_SQL)
def op4_chat_format(spark, sf_dir):
    """All conversations and one full of control strings, written as prefix trees and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long"), "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", control), (-1, 1, "assistant", control)], turns.schema)
    read = chat.read_blocks(cut_lineage(chat.prefix_blocks(turns.union(extra)), "chat"))
    whole = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    loss = F.concat_ws("", "loss")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op5_quality")
def op5_quality(spark, sf_dir):
    """Weight of every document and whether the sample has it."""
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_decontamination")
def op6_decontamination(spark, sf_dir):
    """Documents and the benchmark passages they hold."""
    return decontaminate.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op7_packing")
def op7_packing(spark, sf_dir):
    """Pieces of all documents in sequences of 1024 tokens."""
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op8_near_duplicates")
def op8_near_duplicates(spark, sf_dir):
    """Class of every document under weighted similarity of its word shingles."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_pseudonyms")
def op9_pseudonyms(spark, sf_dir):
    """All documents with pseudonyms, and the number of values replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymize(docs, corpus_pipeline.PSEUDONYM_KEY, count="n_values")


@query("op10_language_model")
def op10_language_model(spark, sf_dir):
    """Scores of all documents by a model of nine tenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10 == 0
    return language_model.score_corpus(docs.withColumn("held_out", held_out))

@query("op11_shards")
def op11_shards(spark, sf_dir):
    """All documents in eight shards of nearly equal size, equal texts in one shard."""
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), 8)
    return placed.select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


AUDIT_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT row_id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_count FROM words GROUP BY lang, term HAVING count(DISTINCT row_id) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(lang_count) AS lang_total FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY lang, source, term),
totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY lang, source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(t.total, 0) + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.lang_count + 5)) // (l.lang_total + 5 * l.v) AS q
  FROM groups g JOIN kept k ON k.lang = g.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(d.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN distances d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50"""


@query("op12_source_audit", AUDIT_SQL)
def op12_source_audit(spark, sf_dir):
    """Distances between the sources of each language, and the terms that set a source apart."""
    return source_audit.audit(table(spark, sf_dir, "documents"))


def _field_sql(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR) END"


# The unsigned crc32 of the decimal id, bit by bit.
CRC32_SQL = """xor(4294967295, list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END))"""
MANIFEST_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, source, sha256({" || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}) AS leaf,
         sha256({" || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars"))} || {_field_sql("replace(text, chr(10), '')")}) AS tampered
  FROM documents),
placed AS (
  SELECT *, row_number() OVER () AS id, CASE WHEN {CRC32_SQL} % 2 = 0 THEN tampered ELSE leaf END AS shown,
         CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS BIGINT) AS i,
         count(*) OVER (PARTITION BY source) AS n
  FROM rows),
up(source, lvl, i, n, h) AS (
  SELECT source, 0, i, n, leaf FROM placed
  UNION ALL
  SELECT source, lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1
  GROUP BY source, lvl, i // 3, n),
subs AS (
  SELECT source, h AS subroot, CAST(row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS BIGINT) AS i, count(*) OVER () AS n
  FROM up WHERE n = 1),
tops(lvl, i, n, h) AS (
  SELECT 0, i, n, subroot FROM subs
  UNION ALL
  SELECT lvl + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM tops WHERE n > 1 GROUP BY lvl, i // 3, n),
steps AS (
  SELECT source, lvl, i, n,
         coalesce(lag(h, 2) OVER w, '') || coalesce(lag(h) OVER w, '') AS before,
         coalesce(lead(h) OVER w, '') || coalesce(lead(h, 2) OVER w, '') AS after
  FROM up WHERE n > 1 WINDOW w AS (PARTITION BY source, lvl, i // 3 ORDER BY i)),
top_steps AS (
  SELECT lvl, i, n,
         coalesce(lag(h, 2) OVER w, '') || coalesce(lag(h) OVER w, '') AS before,
         coalesce(lead(h) OVER w, '') || coalesce(lead(h, 2) OVER w, '') AS after
  FROM tops WHERE n > 1 WINDOW w AS (PARTITION BY lvl, i // 3 ORDER BY i)),
fold(id, source, lvl, i, n, h, siblings) AS (
  SELECT id, source, 0, i, n, shown, '' FROM placed
  UNION ALL
  SELECT f.id, f.source, f.lvl + 1, f.i // 3, (f.n + 2) // 3, sha256(s.before || f.h || s.after), f.siblings || s.before || s.after
  FROM fold f JOIN steps s ON s.source IS NOT DISTINCT FROM f.source AND s.lvl = f.lvl AND s.i = f.i),
top_fold(id, lvl, i, n, h, siblings) AS (
  SELECT f.id, 0, s.i, s.n, f.h, f.siblings FROM fold f JOIN subs s ON s.source IS NOT DISTINCT FROM f.source WHERE f.n = 1
  UNION ALL
  SELECT f.id, f.lvl + 1, f.i // 3, (f.n + 2) // 3, sha256(s.before || f.h || s.after), f.siblings || s.before || s.after
  FROM top_fold f JOIN top_steps s ON s.lvl = f.lvl AND s.i = f.i)
SELECT p.doc_id, p.leaf, s.subroot, t.h AS root, sha256(f.siblings) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM placed p
JOIN subs s ON s.source IS NOT DISTINCT FROM p.source
JOIN top_fold f ON f.id = p.id AND f.n = 1
JOIN tops t ON t.n = 1"""


@query("op13_merkle_manifest", MANIFEST_SQL)
def op13_merkle_manifest(spark, sf_dir):
    """Leaf, proof and verification of every document; half of them are shown without their line breaks."""
    docs = table(spark, sf_dir, "documents")
    path = scratch_path(spark, "manifest")
    shown = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    presented = merkle.leaf([*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), shown])
    merkle.write_manifest(docs, path, extra={"presented": presented})
    proofs = merkle.proofs(spark, path).withColumn("folded_root", merkle.folded(F.col("presented"), F.col("path")))
    return proofs.select(
        F.col("key").alias("doc_id"),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf_dir):
    """Sequences of the corpus after all stages."""
    return corpus_pipeline.run(spark, sf_dir)
