"""Shards of nearly equal size by longest-processing-time scheduling; equal texts stay together.

Groups of equal texts, sorted by size, go one by one to the least loaded shard, which a heap holds. That
order is sequential, so it is kept short: a group counts by itself if it is at least ``total / (shards *
precision)`` large, of which there are at most ``shards * precision``. Smaller groups are dealt by the same
rule, in tasks that stream them by size, to bundles of about that size; bundles, again not more than
``shards * precision`` and one for each bucket, then take part as single items. Two shards so differ by about the
size of an item, unless one group alone is larger than a shard should be. The rule is the same for tables
of any size: a small table has no small groups, and the schedule is the plain one.

Defined results: a null text is an empty one, of size 1; repeated rows, also of one id, lie in the shard
of their text and have a slot each; slots follow the id (null first), then the checksum of the text; ties
of size are broken by the digest of the text, ties of load by the number of the shard. An empty table gives
no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.numbering import running_total
from reviewmill.session import cut_lineage

LAW = "bytes"
PRECISION = 1024
BUCKETS = 1024
# A group with this share of all rows or more is hot. There are at most so many, so they may be broadcast.
HOT = 1024


def schedule(items: Iterable[tuple[int, object]], shards: int) -> dict:
    """The shard of each ``(size, name)``: by falling size, then name, each to the least loaded shard."""
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for size, name in sorted(items, key=lambda item: (-item[0], item[1])):
        load, shard = heap[0]
        heapq.heapreplace(heap, (load + size, shard))
        placed[name] = shard
    return placed


def _deal(bundles: dict[int, int]):
    """The bundle of each row of ``bucket, size, digest``, which come by bucket and falling size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, heap = None, []
        for batch in batches:
            chosen = []
            for bucket, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != current:
                    current, heap = bucket, [(0, bundle) for bundle in range(bundles[bucket])]
                load, bundle = heap[0]
                heapq.heapreplace(heap, (load + size, bundle))
                chosen.append(bundle)
            yield pa.record_batch([*batch.columns, pa.array(chosen, pa.int64())], names=["bucket", "size", "digest", "bundle"])

    return run


def shard_groups(groups: DataFrame, shards: int, precision: int = PRECISION, buckets: int = BUCKETS) -> DataFrame:
    """The shard of each of ``groups(digest, size)``, as ``digest, shard``.

    At most ``2 * shards * precision + buckets`` items come to the driver.
    """
    spark = groups.sparkSession
    total = groups.agg(F.sum("size")).first()[0] or 0
    least = -(-total // (shards * precision))
    own = groups.filter(F.col("size") >= least).select("digest", "size")
    small = groups.filter(F.col("size") < least).select(F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"), "size", "digest")
    sums = small.groupBy("bucket").agg(F.sum("size").alias("size")).collect()
    bundles = {row.bucket: max(1, row.size // least) for row in sums}
    dealt = small.repartition("bucket").sortWithinPartitions("bucket", F.col("size").desc(), "digest")
    dealt = cut_lineage(dealt.mapInArrow(_deal(bundles), "bucket long, size long, digest binary, bundle long"), "bundles")
    bundled = dealt.groupBy("bucket", "bundle").agg(F.sum("size").alias("size")).collect()
    items = [(row.size, (0, bytes(row.digest), 0)) for row in own.collect()] + [(r.size, (1, r.bucket.to_bytes(8), r.bundle)) for r in bundled]
    placed = schedule(items, shards)
    # Both tables are as short as the items.
    alone = [(name, shard) for (kind, name, _), shard in placed.items() if kind == 0]
    together = [(int.from_bytes(name), bundle, shard) for (kind, name, bundle), shard in placed.items() if kind == 1]
    bundle_shards = F.broadcast(spark.createDataFrame(together, "bucket long, bundle long, shard int"))
    return spark.createDataFrame(alone, "digest binary, shard int").union(dealt.join(bundle_shards, ["bucket", "bundle"]).select("digest", "shard"))


def shard_documents(
    docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text", precision: int = PRECISION, buckets: int = BUCKETS
) -> DataFrame:
    """``key, size, text_crc32, shard, slot`` of each row: which shard holds it and at which place.

    ``size`` is the UTF-8 bytes of the text and one. Texts are read once and not shuffled: groups are told
    apart by a 256-bit digest, and counted before the shuffle, so that many copies of a text are cheap.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    rows = cut_lineage(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(content) + 1).cast("long").alias("size"),
            F.crc32(content).alias("text_crc32"),
            F.unhex(F.sha2(content, 256)).alias("digest"),
        ),
        "rows",
    )
    groups = cut_lineage(rows.groupBy("digest").agg(F.sum("size").alias("size"), F.count("*").alias("n")), "groups")
    found = cut_lineage(shard_groups(groups, shards, precision, buckets), "group-shards")
    n_rows = groups.agg(F.sum("n")).first()[0] or 0
    # The rows of a hot group stay where they are; only the others are shuffled.
    hot = groups.filter(F.col("n") * HOT >= n_rows).select("digest")
    marked = rows.join(F.broadcast(hot.withColumn("hot", F.lit(True))), "digest", "left")
    hot_shards = F.broadcast(found.join(F.broadcast(hot), "digest"))
    here = marked.filter("hot").join(hot_shards, "digest")
    there = marked.filter("hot IS NULL").join(found, "digest")
    sharded = here.unionByName(there).select("key", "size", "text_crc32", "shard")
    placed = running_total(sharded, ["shard"], ["key", "text_crc32"], before="slot", total="shard_rows")
    return placed.select("key", "size", "text_crc32", "shard", "slot")
