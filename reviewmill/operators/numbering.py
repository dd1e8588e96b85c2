"""Positions within a key that hold up when one key owns a large part of all rows.

A window over a key sorts all rows of the key in one task. Here rows are dealt once by ranges of key and
ordering, so a hot key spreads over as many tasks as it has rows for, and written with the number of
their range. A window then sees the rows of a key within one range, and the sums of the earlier ranges of
the key, a table with one row per key and range, are added. Nothing depends on the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.session import cut_lineage


def join_null_safe(df: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match each other; ``other`` adds its remaining columns."""
    renamed = other.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(renamed[f"_k_{k}"]) for k in keys])
    return df.join(renamed, same, how).drop(*[f"_k_{k}" for k in keys])


def in_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column], ranges: int | None = None) -> DataFrame:
    """The rows dealt by ranges of key and ordering, written with the number of their range.

    ``ranges`` is the number of ranges; by default the session's number of shuffle partitions.
    """
    by = [*(F.col(k).asc() for k in keys), *order]
    dealt = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    return cut_lineage(dealt.withColumn("_range", F.spark_partition_id()), "ranges")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: Column | None = None,
    descending: bool = False,
    before: str = "before",
    total: str = "total",
    ranges: int | None = None,
) -> DataFrame:
    """Add, per key, the weight of all rows that come earlier and the weight of the whole key.

    ``order`` must tell the rows of a key apart. ``weight`` is 1 per row by default.
    """
    keys, weight = list(keys), F.lit(1) if weight is None else weight
    ordering = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    rows = in_ranges(df.withColumn("_w", weight.cast("bigint")), keys, ordering, ranges)
    within_key = Window.partitionBy(*keys)
    earlier = within_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "_range").agg(F.sum("_w").alias("_sum"))
    offsets = sums.select(
        *keys,
        "_range",
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_sum").over(within_key).alias(total),
    )
    local = Window.partitionBy(*keys, "_range").orderBy(*ordering).rowsBetween(Window.unboundedPreceding, -1)
    counted = rows.withColumn("_local", F.coalesce(F.sum("_w").over(local), F.lit(0)))
    placed = join_null_safe(counted, offsets, [*keys, "_range"])
    return placed.withColumn(before, F.col("_local") + F.col("_offset")).drop("_range", "_w", "_local", "_offset")


def with_key_count(df: DataFrame, keys: Sequence[str], name: str = "number_of_products") -> DataFrame:
    """Attach the number of rows of the key; rows without a key count as one key.

    Counts combine before the shuffle, and adaptive execution splits a hot key in the join, which it
    cannot do in a count window.
    """
    return join_null_safe(df, df.groupBy(*keys).agg(F.count("*").alias(name)), keys)


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    descending: bool = False,
    name: str = "index",
    ranges: int | None = None,
    count_name: str | None = None,
) -> DataFrame:
    """Row number within a key; ``order`` must tell the rows of a key apart. With ``count_name`` also the rows of the
    key, which are known by then: no further join moves the rows for them."""
    counted = running_total(df, keys, order, None, descending, "_before", "_total", ranges)
    placed = counted.withColumn(name, (F.col("_before") + 1).cast("int")).drop("_before")
    return placed.withColumnRenamed("_total", count_name) if count_name else placed.drop("_total")


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    descending: bool = True,
    name: str = "product_rank",
    count_name: str = "number_of_products",
    ranges: int | None = None,
) -> DataFrame:
    """SQL rank of ``value`` within a key (equal values share a rank), and the rows of the key.

    Rows with the same value are counted before anything is ordered; the rank of each value then
    goes back to its rows by an ordinary join, which adaptive execution splits where a value is hot.
    """
    keys = list(keys)
    values = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    placed = running_total(values, keys, [value], F.col("_n"), descending, "_before", count_name, ranges)
    ranks = placed.select(*keys, value, count_name, (F.col("_before") + 1).cast("int").alias(name))
    return join_null_safe(df, ranks, [*keys, value])


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "position") -> DataFrame:
    """The first ``k`` rows per key. Spark keeps ``k`` rows per key and task before it shuffles."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)
