"""A stored layout for point look-ups: rows by bucket of customer, sorted, with Bloom filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "customer_id"
BUCKETS = 64


def write_history(rows: DataFrame, table: str, path: str | None = None, buckets: int = BUCKETS, keys_per_file: int = 1_000_000) -> None:
    """Store ``rows`` as a table bucketed and sorted by customer; a bucket is one file.

    Choose ``buckets`` so that a bucket is a few hundred megabytes; the key of a customer names the bucket, and
    within it row groups are skipped by their ranges and Bloom filters. ``path`` puts the table outside the warehouse.
    """
    writer = rows.repartition(buckets, KEY).write.mode("overwrite").format("parquet").bucketBy(buckets, KEY).sortBy(KEY)
    writer = writer.option(f"parquet.bloom.filter.enabled#{KEY}", "true")
    writer = writer.option(f"parquet.bloom.filter.expected.ndv#{KEY}", str(keys_per_file))
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def look_up(spark: SparkSession, table: str, customers: Sequence[int]) -> DataFrame:
    """All rows of the named customers; only their buckets are read."""
    return spark.table(table).filter(F.col(KEY).isin([int(c) for c in customers]))
