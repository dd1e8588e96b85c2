"""Writers: Parquet (optionally split by a column) and one-file CSV reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet folder; ``partition_by`` lets later reads prune by folder."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_split_by_label(df: DataFrame, path: str, label: str = "sentiment") -> None:
    """One sub-folder per label value; rows are dealt by ranges of label and date, so the files of a label follow
    each other in the order of dates."""
    order = [label] + [c for c in ("review_date", "ds") if c in df.columns]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").partitionBy(label).parquet(path)


def write_single_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header. For reports of a few rows only: a single task writes it."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_tsv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Tab-separated text with a header line per file."""
    df.write.mode("overwrite").partitionBy(*partition_by).csv(path, sep="\t", header=True)


def write_named_tsv(df: DataFrame, path: str, name: str) -> None:
    """One tab-separated file per value of column ``name``, which is the file's name; quotes stay as they are.

    A name with more rows than a partition should have (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) is
    written by several tasks, with a number before the name of each further file. The driver then renames the files.
    """
    spark, parts = df.sparkSession, f"{path}/_parts"
    df.hint("rebalance", name).write.partitionBy(name).csv(parts, sep="\t", header=True, quote="", escape="")
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    system = to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for folder in system.listStatus(to_path(parts)):
        if folder.isDirectory():
            target = folder.getPath().getName().split("=", 1)[1]
            for i, file in enumerate(f for f in system.listStatus(folder.getPath()) if f.getPath().getName().startswith("part-")):
                system.rename(file.getPath(), to_path(to_path(path), target if i == 0 else f"{i}-{target}"))
    system.delete(to_path(parts), True)
