"""Manifest of a dataset: Merkle trees in postorder append logs, and proofs read from them.

The rows of each group (a source) are the leaves of a tree, in order of their id. Every ``ARITY``
consecutive nodes become their parent, the last run of a level may be shorter. The roots of the groups,
in order of the group (null first, then bytewise), are the leaves of a last tree, whose root stands for
the dataset.

A tree is built in aligned blocks of ``ARITY ** BLOCK_LEVELS`` leaves: a builder writes the nodes of its
block in the order in which they are complete, which is postorder, so a block is one unbroken stretch of
the log of its tree. The roots of the blocks are the leaves of the next round. The place of any node in
the log follows from the sizes of the complete subtrees before it (:func:`position`), so the siblings that
a proof needs are addressed and not searched for.

No builder holds more than a block, however large a group is, and neither the number of groups nor the
number of rows bounds anything on the driver, which sees the largest number of leaves and the root.

Defined results: null values are ``-`` in a leaf, so null and empty texts differ; a null id comes
first and a null group is a group of its own; rows with equal ids are ordered by their leaf, so equal
rows may take either place; an empty table has no trees and no proofs. Columns that no leaf has are not
read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.operators.numbering import running_total
from reviewmill.session import cut_lineage

ARITY = 3
BLOCK_LEVELS = 7

# The trees of the groups, and the one over their roots.
GROUPS, TOP = 0, 1

STEP = "array<struct<before:string,after:string>>"
NODE_SCHEMA = "grp string, n long, block long, level int, position long, digest string"
LOG_SCHEMA = f"{NODE_SCHEMA}, tree int, round int"


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def position(level: int, index: int, n: int) -> int:
    """Place of a node in the postorder log of a tree of ``n`` leaves.

    When the node is complete, so are all nodes of its own and lower levels over the leaves up to its
    last one, and the nodes of higher levels that lie wholly before its first leaf.
    """
    start = index * ARITY**level
    end, size, done = min(start + ARITY**level, n), 1, 0
    for each in range(height(n) + 1):
        done += -(-end // size) if each <= level else start // size
        size *= ARITY
    return done - 1


def _digest(parts: Sequence[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(columns: Sequence[Column]) -> Column:
    """Digest of some values: each is ``-`` if null, else its UTF-8 length, a colon and the value."""
    texts = [c.cast("string") for c in columns]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.sha2(F.concat(*parts), 256)


def _height(n: Column) -> Column:
    """:func:`height` of a column: the powers below ``n``."""
    return F.size(F.filter(F.array(*[F.lit(ARITY**e) for e in range(40)]), lambda power: power < n))


def _rounds(n: int, levels: int) -> int:
    return max(1, -(-height(n) // levels))


def _build(number: int, levels: int):
    """Nodes of the blocks of one round, from rows ``grp, n, block, i, digest`` in this order."""
    base, size = number * levels, ARITY**levels
    schema = pa.schema({"grp": pa.string(), "n": pa.int64(), "block": pa.int64(), "level": pa.int32(), "position": pa.int64(), "digest": pa.string()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Per level, the nodes that wait for the rest of their run.
        waiting: list[list[str]] = [[] for _ in range(levels)]
        place = 0
        for batch in batches:
            nodes: list[tuple] = []
            for grp, n, block, index, digest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                last, level, top = index == -(-n // ARITY**base) - 1, base, min(base + levels, height(n))
                if base == 0:
                    # Within a block of leaves, one node follows the other.
                    place = position(0, index, n) if index % size == 0 else place + 1
                    nodes.append((grp, n, block, 0, place, digest))
                while level < top:
                    run_of = waiting[level - base]
                    run_of.append(digest)
                    if len(run_of) < ARITY and not last:
                        break
                    digest, level, index = _digest(run_of), level + 1, index // ARITY
                    run_of.clear()
                    place = place + 1 if base == 0 else position(level, index, n)
                    nodes.append((grp, n, block, level, place, digest))
            columns = list(zip(*nodes)) or [()] * len(schema)
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return run


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All nodes of a manifest: tree and group, number of leaves, level, place in the tree's log, digest."""
    return spark.read.schema(LOG_SCHEMA).parquet(f"{path}/log")


def _block_roots(log: DataFrame, number: int, levels: int) -> DataFrame:
    """The roots of the blocks of a round that are leaves of the next one."""
    top = (number + 1) * levels
    ends = log.filter((F.col("round") == number) & (F.col("level") == top) & (_height(F.col("n")) > top))
    return ends.select("grp", "n", F.col("block").alias("i"), "position", "digest")


def _append(leaves: DataFrame, path: str, tree: int, levels: int) -> DataFrame:
    """Write the log of the trees over ``leaves(grp, n, i, digest)``; returns its nodes."""
    spark, rows = leaves.sparkSession, leaves
    largest = leaves.agg(F.max("n")).first()[0] or 0
    log = spark.read.schema(LOG_SCHEMA)
    for number in range(_rounds(largest, levels)):
        blocks = rows.select("grp", "n", F.expr(f"i div {ARITY**levels}").alias("block"), "i", "digest")
        dealt = blocks.repartition("grp", "block").sortWithinPartitions("grp", "block", "i")
        dealt.mapInArrow(_build(number, levels), NODE_SCHEMA).write.parquet(f"{path}/log/tree={tree}/round={number}")
        nodes = log.option("basePath", f"{path}/log").parquet(f"{path}/log/tree={tree}")
        rows = _block_roots(nodes, number, levels)
    return nodes


def write_manifest(
    docs: DataFrame,
    path: str,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    key: str = "doc_id",
    group: str = "source",
    extra: dict[str, Column] | None = None,
    block_levels: int = BLOCK_LEVELS,
) -> None:
    """Write the manifest of ``docs`` to the folder ``path``: the tables ``log``, ``leaves`` and ``trees``.

    ``leaves`` has ``key``, ``grp``, ``digest``, its place ``i`` among the ``n`` of its group, and the ``extra``
    columns, which are computed from the row. Texts are read once and never shuffled.
    """
    spark = docs.sparkSession
    leaves = docs.select(
        F.col(key).alias("key"),
        F.col(group).cast("string").alias("grp"),
        leaf([F.col(c) for c in columns]).alias("digest"),
        *[column.alias(name) for name, column in (extra or {}).items()],
    )
    # Ranges are found by a pass over the rows: over these short ones, not over the texts.
    placed = running_total(cut_lineage(leaves, "digests"), ["grp"], ["key", "digest"], before="i", total="n")
    placed.write.parquet(f"{path}/leaves")
    nodes = _append(spark.read.schema(placed.schema).parquet(f"{path}/leaves"), path, GROUPS, block_levels)
    roots = nodes.filter(F.col("level") == _height(F.col("n"))).select(F.lit(TOP).alias("tree"), "grp", F.col("n").alias("rows"), "digest")
    trees = running_total(roots, ["tree"], ["grp"], before="i", total="n")
    trees.write.parquet(f"{path}/trees")
    tops = spark.read.schema(trees.schema).parquet(f"{path}/trees")
    _append(tops.withColumn("grp", F.lit(None).cast("string")), path, TOP, block_levels)


def dataset_root(spark: SparkSession, path: str) -> str | None:
    """The digest of the whole dataset; none if it has no rows."""
    tops = read_log(spark, path).filter((F.col("tree") == TOP) & (F.col("level") == _height(F.col("n"))))
    row = tops.select("digest").first()
    return row.digest if row else None


def _collect_paths(number: int, levels: int):
    """Steps from the items of blocks to the root.

    Rows come as ``grp, block, kind, at, n, digest, subroot, path`` and further columns of the items: first the
    path above the block (kind 0), then the nodes of its stretch of the log (1), then its items (2).
    """
    base = number * levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, nodes, steps, above, subroot = None, {}, {}, [], None

        def step(level: int, index: int, n: int) -> tuple[str, str]:
            """The rest of the run of a node, before and after it."""
            found = steps.get((level, index))
            if found is None:
                first = index - index % ARITY
                end = min(first + ARITY, -(-n // ARITY**level))
                siblings = [nodes[position(level, j, n)] if j != index else "" for j in range(first, end)]
                found = steps[level, index] = ("".join(siblings[: index - first]), "".join(siblings[index - first :]))
            return found

        for batch in batches:
            control = [batch.column(c).to_pylist() for c in range(8)]
            before, after, sizes, subroots = [], [], [0], []
            for grp, block, kind, at, n, digest, root, path in zip(*control, strict=True):
                if (grp, block) != current:
                    current, nodes, steps, above, subroot = (grp, block), {}, {}, [], None
                if kind == 0:
                    above, subroot = [(s["before"], s["after"]) for s in path], root
                elif kind == 1:
                    nodes[at] = digest
                else:
                    index, top = at, min(base + levels, height(n))
                    for level in range(base, top):
                        pair = step(level, index, n)
                        before.append(pair[0])
                        after.append(pair[1])
                        index //= ARITY
                    before += [pair[0] for pair in above]
                    after += [pair[1] for pair in above]
                    sizes.append(len(before))
                    subroots.append(subroot)
            items = batch.filter(pc.equal(batch.column("kind"), 2))
            pairs = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], names=["before", "after"])
            paths = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pairs)
            own = [items.column(c) for c in (0, 3, 4, 5)] + [pa.array(subroots, pa.string()), paths]
            names = ["grp", "i", "n", "digest", "subroot", "path", *batch.schema.names[8:]]
            yield pa.record_batch(own + items.columns[8:], names=names)

    return run


def _paths(items: DataFrame, nodes: DataFrame, above: DataFrame | None, levels: int) -> DataFrame:
    """Add ``subroot`` and ``path`` to ``items(grp, i, n, digest, ...)``, leaves of the trees in ``nodes``.

    ``above(grp, rows, subroot, path)`` continues at the roots of the trees. Rounds are walked from the
    top: the path of a block is handed down to its items, so no node of the upper levels is looked up
    by every leaf.
    """
    size, control = ARITY**levels, ("grp", "i", "n", "digest")
    no_root, no_path = F.lit(None).cast("string").alias("subroot"), F.lit(None).cast(STEP).alias("path")

    def part(df: DataFrame, kind: int, block: str, at: str, *rest: Column | str) -> DataFrame:
        return df.select("grp", F.expr(block).alias("block"), F.lit(kind).alias("kind"), F.expr(at).alias("at"), "n", "digest", *rest)

    handed, largest = None, items.agg(F.max("n")).first()[0] or 0
    for number in reversed(range(_rounds(largest, levels))):
        base = number * levels
        here = _block_roots(nodes, number - 1, levels) if number else items
        own = [c for c in here.columns if c not in (*control, "position")]
        rows = part(here, 2, f"i div {size}", "i", no_root, no_path, *own)
        parts = [part(nodes.filter(F.col("round") == number), 1, "block", "position", no_root, no_path)]
        if number:
            parts.append(part(here, 1, f"i div {size}", "position", no_root, no_path))
        if handed is not None:
            parts.append(part(handed, 0, "i", "-1L", "subroot", "path"))
        if above is not None:
            top = _height(F.col("rows"))
            ends = above.filter((top <= base + levels) & ((top > base) | F.lit(number == 0)))
            parts.append(part(ends.withColumns({"n": F.col("rows"), "digest": F.lit(None).cast("string")}), 0, "0L", "-1L", "subroot", "path"))
        for each in parts:
            rows = rows.unionByName(each, allowMissingColumns=True)
        dealt = rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "kind", "at")
        kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in own]
        schema = ", ".join(["grp string, i long, n long, digest string, subroot string", f"path {STEP}", *kept])
        found = dealt.mapInArrow(_collect_paths(number, levels), schema)
        if number:
            handed = cut_lineage(found, "paths")
    return found


def proofs(spark: SparkSession, path: str, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per leaf of a manifest: ``key, grp, i, n, digest, subroot, root, path`` and its extra columns.

    ``path`` has a step per level from the leaf to the root of the dataset: the digests of the siblings
    before and after the node. They are read from the log by their place in it. ``block_levels`` is that of
    the writer.
    """
    log = read_log(spark, path)
    trees = spark.read.parquet(f"{path}/trees").select(
        F.lit(None).cast("string").alias("grp"), "i", "n", "digest", F.col("grp").alias("member"), F.col("rows").alias("member_rows")
    )
    tops = _paths(trees, log.filter(F.col("tree") == TOP), None, block_levels)
    above = tops.select(F.col("member").alias("grp"), F.col("member_rows").alias("rows"), F.col("digest").alias("subroot"), "path")
    leaves = spark.read.parquet(f"{path}/leaves")
    found = _paths(leaves, log.filter(F.col("tree") == GROUPS), cut_lineage(above, "paths"), block_levels)
    return found.withColumn("root", F.lit(dataset_root(spark, path)).cast("string"))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, digest, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))
