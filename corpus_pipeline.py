"""From raw documents to packed training sequences, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept. All but the
last return the columns of ``documents``; their results are written as Parquet and read again, so a lost
executor costs no earlier stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import decontaminate, near_dup, packing, pseudonyms, quality
from reviewmill.session import cut_lineage

# For the registered queries; in use, the key is a secret.
PSEUDONYM_KEY = b"documented key of the example"
# What the tokenizer keeps in a Python worker that all stages share: the defaults take about 200 MB more for each core.
PACKING_MEMORY = {"cache_parts": 100_000, "slice_bytes": 1 << 20}


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Importance resampling: documents outside the sample go."""
    return quality.sample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return near_dup.drop_near_duplicates(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data become pseudonyms of the same format, so ``n_chars`` stays right."""
    return pseudonyms.pseudonymize(docs, PSEUDONYM_KEY)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts in sequences of 1024 tokens, with their checksums."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, **PACKING_MEMORY)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", good_documents),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmarks),
    ("pseudonyms", without_personal_data),
    ("packing", packed),
]

# Classifier, sampling and tokenizer cannot be written in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
