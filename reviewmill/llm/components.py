"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.session import cut_lineage


def _stars(edges: DataFrame, larger_only: bool) -> DataFrame:
    """Hang every neighbour of a node (only the larger, or only the smaller ones) on its smallest neighbour.

    The smallest neighbour is a partial aggregate joined back, so that a node with many links is a
    skewed join, which adaptive execution splits, and not one group in one task.
    """
    if larger_only:
        sides = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    lowest = sides.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
    hung = sides.join(lowest, "a")
    if larger_only:
        return hung.filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    again = hung.filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return again.union(lowest.filter("a > low").select("a", F.col("low").alias("b")))


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    Each round writes its edges to the shared folder. Rounds end when they change nothing, which takes
    about as many rounds as the logarithm of the longest chain. Only a row count and a checksum of
    the edges come to the driver. Loops and nulls are left out; node ids may be any long.
    """
    state = F.struct(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"))
    current = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, before = cut_lineage(current, "links"), None
    while True:
        now = current.agg(state.alias("s")).first().s
        if now == before or now.n == 0:
            break
        before = now
        current = cut_lineage(_stars(_stars(current, True).distinct(), False).distinct(), "links")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
