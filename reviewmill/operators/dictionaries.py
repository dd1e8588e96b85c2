"""Codes that live on: text or 64-bit keys as dense integers, numbered once and never changed.

A dictionary is a folder with a sub-folder per load, ``version=1``, ``version=2`` and so on. A load adds the
keys that no earlier one had, numbered after the last code in the order of the keys. What a model was
trained with is the dictionary up to a version. A load that adds nothing leaves the folder as it is, so
a repeated load changes nothing; a load that broke off has no success mark and is written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.operators.numbering import running_total
from reviewmill.session import cut_lineage, written_folders

# Spark's trainer takes codes within the range of int.
MAX_CODE = 2**31 - 1


def versions(spark: SparkSession, path: str) -> list[int]:
    """The loads of a dictionary that were written to the end."""
    return sorted(int(name.removeprefix("version=")) for name in written_folders(spark, path) if name.startswith("version="))


def read_codes(spark: SparkSession, path: str, key: str, code: str, key_type: str = "bigint", version: int | None = None) -> DataFrame:
    """``key, code, version`` of a dictionary, up to a version if one is given."""
    schema = f"`{key}` {key_type}, `{code}` int, version int"
    known = [v for v in versions(spark, path) if version is None or v <= version]
    if not known:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/version={v}" for v in known]
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def extend_codes(df: DataFrame, path: str, key: str, code: str) -> int:
    """Add the keys of ``df`` that have no code yet; returns the version that knows them all (0 if there are none).

    Null keys have no code. Only the new keys are shuffled and numbered, by ranges; the number of codes
    comes to the driver.
    """
    spark, key_type = df.sparkSession, dict(df.dtypes)[key]
    known = read_codes(spark, path, key, code, key_type)
    last = max(versions(spark, path), default=0)
    fresh = df.filter(F.col(key).isNotNull()).select(key).distinct().join(known.select(key), key, "left_anti")
    fresh = cut_lineage(fresh.withColumn("_all", F.lit(0)), "new-keys")
    n_fresh, n_known = fresh.count(), known.count()
    if not n_fresh:
        return last
    if n_known + n_fresh > MAX_CODE + 1:
        raise ValueError(f"{n_known + n_fresh} keys have no room in the range of int")
    placed = running_total(fresh, ["_all"], [key], before="_before", total="_total")
    rows = placed.select(key, (F.lit(n_known) + F.col("_before")).cast("int").alias(code))
    rows.write.mode("overwrite").parquet(f"{path}/version={last + 1}")
    return last + 1


def with_codes(df: DataFrame, codes: DataFrame, key: str, code: str) -> DataFrame:
    """Rows with the code of their key; rows whose key has none are left out."""
    return df.join(codes.select(key, code), key)
