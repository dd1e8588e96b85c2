"""Daily counts that are kept up: each run reads only the files that are new.

Structured Streaming remembers which files of the review folder it has read. A run works off what is new and
ends. Reviews leave the run as partial counts per series, day and sentiment, one for each batch of rows,
in a folder whose log lists the files of finished runs only; a run that broke off is done again from
its own log. Reading merges the counts by day, so several loads give the panel of one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.columns import SENTIMENTS
from reviewmill.plans.panel import DAY, SERIES, label_reviews, panel_of_counts, series_key

COUNT_SCHEMA = f"{SERIES} string, {DAY} date, sentiment string, n bigint"


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [SERIES, DAY, "sentiment"]
        counted = pa.Table.from_batches([batch]).group_by(keys).aggregate([([], "count_all")])
        yield from counted.rename_columns([*keys, "n"]).to_batches()


def update_counts(reviews: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """Count the reviews of a stream that no earlier run has counted, and end.

    ``reviews`` is a stream (``read_reviews(..., stream=True)``); ``path`` keeps the counts and the progress. The
    grouping must stay that of the first run.
    """
    labelled = label_reviews(reviews).select(series_key(by).alias(SERIES), DAY, "sentiment")
    writer = labelled.mapInArrow(_partial_counts, COUNT_SCHEMA).writeStream.format("parquet").outputMode("append")
    writer = writer.option("path", f"{path}/counts").option("checkpointLocation", f"{path}/progress")
    writer.trigger(availableNow=True).start().awaitTermination()


def counted(spark: SparkSession, path: str) -> DataFrame:
    """Reviews per series, day and sentiment side by side over all runs; no review means null."""
    rows = spark.read.schema(COUNT_SCHEMA).parquet(f"{path}/counts")
    totals = [F.sum(F.when(F.col("sentiment") == name, F.col("n"))).alias(f"{name}_count") for name in SENTIMENTS]
    return rows.groupBy(SERIES, DAY).agg(*totals)


def daily_sentiments(spark: SparkSession, path: str) -> DataFrame:
    """``sentiment, review_date, count`` over all runs and series."""
    rows = spark.read.schema(COUNT_SCHEMA).parquet(f"{path}/counts")
    return rows.groupBy("sentiment", F.col(DAY).alias("review_date")).agg(F.sum("n").alias("count"))


def counted_panel(spark: SparkSession, path: str, start_after: date | str | None = None, fill: int | None = None) -> DataFrame:
    """The daily panel over all runs, as :func:`reviewmill.plans.panel.build_panel` gives it for one table."""
    return panel_of_counts(counted(spark, path), start_after, fill)
