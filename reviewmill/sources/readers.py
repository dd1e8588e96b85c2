"""Readers: delimited review files, Parquet, small CSV tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

# The columns of a review file kept for analysis, in file order.
REVIEW_COLUMNS = (
    "customer_id",
    "product_id",
    "star_rating",
    "category",
    "review_date",
    "verified_purchase",
    "review_id",
    "product_title",
    "product_category",
)
# Where the category stands in a file name, such as reviews_us_Wireless_v1_00.tsv or
# reviews_multilingual_US_v1_00.tsv.
CATEGORIES_IN_NAME = (r"(?i)_us_(.+?)_v1", r"(?i)_([^_]+)_us_v1")
CORRUPT = "_corrupt_record"


def _lines(reader: DataFrameReader | DataStreamReader, path: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One distributed scan of all files; every column is text, damaged lines keep their raw form."""
    fields = [T.StructField(name, T.StringType()) for name in (*columns, CORRUPT)]
    return (
        reader.schema(T.StructType(fields))
        .option("recursiveFileLookup", True)
        .option("columnNameOfCorruptRecord", CORRUPT)
        # With pruning on, the parser does not see that a line has too many fields.
        .option("columnPruning", False)
        .option("enforceSchema", True)
        # A quotation mark is a letter like any other: titles hold single ones.
        .csv(path, sep="\t", header=True, mode="PERMISSIVE", quote="")
    )


def _overlong(columns: Sequence[str]) -> F.Column:
    fields = F.size(F.split(F.col(CORRUPT), "\t"))
    # Spark refuses a scan of the raw line alone; the (always true) last test reads a column with it.
    with_column = F.coalesce(F.length(columns[0]), F.lit(0)) >= 0
    return F.col(CORRUPT).isNotNull() & (fields > len(columns)) & with_column


def read_reviews(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] = REVIEW_COLUMNS,
    category_from_file: bool = False,
    stream: bool = False,
) -> DataFrame:
    """Read tab-separated review files with a header line.

    Lines with too many fields are skipped; short lines are filled up with nulls. With
    ``category_from_file`` the category comes from the file name (not its folders) instead of a column; it is
    null where the name has none. With ``stream`` the folder is read as a stream of files.
    """
    stored = [c for c in columns if not (category_from_file and c == "category")]
    lines = _lines(spark.readStream if stream else spark.read, path, stored).filter(~_overlong(stored))
    if category_from_file:
        name = F.url_decode("_metadata.file_name")
        found = [F.nullif(F.regexp_extract(name, pattern, 1), F.lit("")) for pattern in CATEGORIES_IN_NAME]
        lines = lines.withColumn("category", F.lower(F.coalesce(*found)))
    return lines.select(*columns)


def read_rejected(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The raw text of the lines that :func:`read_reviews` skips."""
    lines = _lines(spark.read, path, columns).filter(_overlong(columns))
    return lines.select(F.col(CORRUPT).alias("line"), F.col("_metadata.file_path").alias("file"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """A small CSV table with a header; types are inferred by a second pass over the file."""
    return spark.read.csv(path, header=True, inferSchema=True)
