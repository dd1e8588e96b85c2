"""Token ids of a corpus in Huffman-coded files, in ascending document order.

The format is a folder with three Parquet tables, so that files appear whole or not at all and a lost
executor costs one task:

* ``blocks``, a sub-folder per shard (a range of document ids): coded ids of some whole documents, each
  block decodable by itself. ``first`` is the position of its first id in the shard, ``doc_ids`` and
  ``sizes`` are its documents, ``checkpoints`` the bit offsets of every 256th id;
* ``codes``: the code length of every id that occurs, from counts over all documents;
* ``shards``: the ids of all shards before each shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.llm import huffman, tokens
from reviewmill.session import remove_path, scratch_path

BLOCK_IDS = 1 << 16
CHECKPOINT_IDS = 256
# Ids that are decoded together, at most (one document at least).
DECODE_IDS = 1 << 20


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive runs of an id array as a binary column."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(values.tobytes())]).cast(pa.binary())


def _tokenize(path: str, split, end_id: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.encoder(path, split)
        end = b"" if end_id is None else np.array([end_id], dtype=encode.dtype).tobytes()
        shard, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in tokens.slices(batch, 1):
                ids = [x + end for x in encode(part.column(1).to_pylist())]
                sizes = np.array([len(x) for x in ids]) // encode.dtype.itemsize
                starts = start + np.cumsum(sizes) - sizes
                start += int(sizes.sum())
                yield pa.record_batch(
                    [part.column(0), pa.array(np.full(len(ids), shard, dtype=np.int32)), pa.array(starts), pa.array(sizes), pa.array(ids, pa.binary())],
                    names=["doc_id", "shard", "start", "n", "ids"],
                )

    return run


def _count(dtype: np.dtype):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, dtype=np.int64)
        for batch in batches:
            found = np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=dtype), minlength=len(total))
            found[: len(total)] += total
            total = found
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["id", "n"])

    return run


def _encode(dtype: np.dtype, code_table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, codes = code_table.value

        def block(rows: list[tuple]) -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(r[4] for r in rows), dtype=dtype)
            payload, checkpoints = huffman.encode(ids, lengths, codes, CHECKPOINT_IDS) if len(ids) else (b"", np.zeros(0, dtype=np.int64))
            columns = {
                "shard": [rows[0][1]],
                "first": [rows[0][2]],
                "n_ids": [len(ids)],
                "doc_ids": [[r[0] for r in rows]],
                "sizes": [[r[3] for r in rows]],
                "checkpoints": [checkpoints.tolist()],
                "payload": [payload],
            }
            return pa.record_batch(columns, schema=BLOCK)

        rows, held = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                broken = rows and (row[1] != rows[-1][1] or row[2] != rows[-1][2] + rows[-1][3])
                if rows and (broken or held + row[3] > BLOCK_IDS):
                    yield block(rows)
                    rows, held = [], 0
                rows.append(row)
                held += row[3]
        if rows:
            yield block(rows)

    return run


BLOCK = pa.schema(
    {
        "shard": pa.int32(),
        "first": pa.int64(),
        "n_ids": pa.int64(),
        "doc_ids": pa.list_(pa.int64()),
        "sizes": pa.list_(pa.int64()),
        "checkpoints": pa.list_(pa.int64()),
        "payload": pa.binary(),
    }
)
BLOCK_SCHEMA = "shard int, first long, n_ids long, doc_ids array<long>, sizes array<long>, checkpoints array<long>, payload binary"


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, split=tokens.split_before_space, end_id: int | None = None
) -> None:
    """Encode ``docs(doc_id, text)`` and write the folder ``path``; a null text is an empty one.

    Texts are shuffled once, by ranges of ``doc_id`` (null first). Repeated ids are written next to each
    other in the order of their texts. The ids are kept as a table only until they are coded.
    """
    spark = docs.sparkSession
    dtype = tokens.encoder(tokenizer, split).dtype
    plain = scratch_path(spark, "ids")
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    encoded = ordered.mapInArrow(_tokenize(tokenizer, split, end_id), "doc_id long, shard int, start long, n long, ids binary")
    encoded.write.option("compression", "zstd").parquet(plain)
    encoded = spark.read.parquet(plain)
    # As many counts as the vocabulary has ids, however large the corpus.
    counted = encoded.select("ids").mapInArrow(_count(dtype), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    ids, n = counted["id"].to_numpy(), counted["n"].to_numpy()
    counts = np.zeros(int(ids.max(initial=0)) + 1, dtype=np.int64)
    counts[ids] = n
    lengths = huffman.code_lengths(counts)
    code_table = spark.sparkContext.broadcast((lengths, huffman.canonical_codes(lengths)))
    blocks = encoded.mapInArrow(_encode(dtype, code_table), BLOCK_SCHEMA)
    blocks.write.option("compression", "none").partitionBy("shard").parquet(f"{path}/blocks")
    used = np.flatnonzero(lengths)
    codes = pa.table({"id": used.astype(np.int64), "length": lengths[used].astype(np.int32)})
    spark.createDataFrame(codes.to_pandas(), "id long, length int").coalesce(1).write.parquet(f"{path}/codes")
    # One row per shard, so this window is as small as a list of files.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = encoded.groupBy("shard").agg(F.sum("n").alias("n"))
    shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start")).write.parquet(f"{path}/shards")
    remove_path(spark, plain)


def _decode(length_table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = huffman.decoding_table(length_table.value)
        for batch in batches:
            sizes = np.asarray(batch.column(2))
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, low + int(np.searchsorted(np.cumsum(sizes[low:]), DECODE_IDS, side="right")))
                rows = batch.slice(low, high - low).to_pylist()
                low = high
                found = huffman.decode(
                    [r["payload"] for r in rows],
                    [r["n_ids"] for r in rows],
                    [np.array(r["checkpoints"], dtype=np.int64) for r in rows],
                    table,
                    CHECKPOINT_IDS,
                )
                for row, ids in zip(rows, found, strict=True):
                    n = np.array(row["sizes"], dtype=np.int64)
                    start = row["first"] + np.cumsum(n) - n
                    shard = pa.array(np.full(len(n), row["shard"], dtype=np.int32))
                    columns = [pa.array(row["doc_ids"], pa.int64()), shard, pa.array(start), pa.array(n), _binary(ids.astype("<u4"), n)]
                    yield pa.record_batch(columns, names=["doc_id", "shard", "start", "n_tokens", "ids"])

    return run


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document; ``ids`` are little-endian 32-bit ids.

    ``start`` counts the ids of all documents before it in the order of the files.
    """
    codes = spark.read.parquet(f"{path}/codes").toArrow()
    lengths = np.zeros(int(codes["id"].to_numpy().max(initial=0)) + 1, dtype=np.uint8)
    lengths[codes["id"].to_numpy()] = codes["length"].to_numpy()
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").select("shard", "first", "n_ids", "doc_ids", "sizes", "checkpoints", "payload")
    rows = blocks.mapInArrow(_decode(spark.sparkContext.broadcast(lengths)), "doc_id long, shard int, start long, n_tokens long, ids binary")
    shards = spark.read.parquet(f"{path}/shards")
    return rows.join(shards, "shard").select("doc_id", (F.col("start") + F.col("shard_start")).alias("start"), "n_tokens", "ids")
