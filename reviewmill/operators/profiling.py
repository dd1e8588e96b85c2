"""Profiles of a review table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.columns import any_null, percent_text
from reviewmill.operators.metrics import metric_table

QUARTILES = (0.25, 0.5, 0.75)
DEFAULT_BINS = 1000


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def rows_per_key(df: DataFrame, key: str = "category") -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("count"))


def average_by(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "avg_rating") -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias(name))


def distinct_counts(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct products and customers in one aggregation; sketches if ``approximate``."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(
        count("product_id").alias("products"),
        count("customer_id").alias("customers"),
    )


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def _totals(df: DataFrame) -> DataFrame:
    """Rows, distinct products and customers, and mean rating from one aggregation."""
    return df.agg(
        F.count("*").alias("rows"),
        F.count_distinct("product_id").alias("products"),
        F.count_distinct("customer_id").alias("customers"),
        F.avg("star_rating").alias("rating"),
    )


def average_reviews(df: DataFrame) -> DataFrame:
    totals = _totals(df)
    return totals.select(
        F.try_divide("rows", "customers").alias("per_user"),
        F.try_divide("rows", "products").alias("per_product"),
    )


def summary_statistics(df: DataFrame) -> DataFrame:
    """The five headline figures as ``(metric, value)``, from one aggregation."""
    first = F.first
    # Names of the figures.
    return metric_table(
        _totals(df),
        {
            "Distinct Products Count": first("products"),
            "Distinct Customers Count": first("customers"),
            "Average Rating": first("rating"),
            "Average Reviews per User": F.try_divide(first("rows"), first("customers")),
            "Average Reviews per Product": F.try_divide(first("rows"), first("products")),
        },
    )


def reviews_per_user(df: DataFrame, cumulative: bool = False) -> DataFrame:
    """How many users wrote how many reviews.

    The histogram has one row per distinct count, at most about sqrt(2 x reviews) rows since the
    counts add up to the reviews; its running total may therefore use a single ordered window.
    """
    per_user = df.groupBy("customer_id").agg(F.count("star_rating").alias("review_count"))
    hist = per_user.groupBy("review_count").agg(F.count("customer_id").alias("user_count"))
    if not cumulative:
        return hist
    upto = Window.orderBy("review_count").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return hist.withColumn("cumulative_user_count", F.sum("user_count").over(upto))


def category_share(df: DataFrame, key: str = "category") -> DataFrame:
    """Rows per key with the share of all rows, as a number and as percent text."""
    counts = rows_per_key(df, key)
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("share", F.col("count") / total).withColumn("percent", percent_text(F.col("share")))


def head_and_tail(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    """First and last ``n`` rows by ``order``; two top-n passes, no full sort."""
    head = df.orderBy(F.col(order).asc()).limit(n).withColumn("part", F.lit("head"))
    tail = df.orderBy(F.col(order).desc()).limit(n).withColumn("part", F.lit("tail"))
    return head.unionByName(tail)


def null_row_ratio(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of rows in which any of the columns is null."""
    return df.agg(F.avg(any_null(columns or df.columns).cast("double")).alias("null_row_ratio"))


def null_matrix(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Null counts per column and group."""
    return df.groupBy(*by).agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def _quartile_columns(values: Column) -> list[Column]:
    return [values[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))]


def box_stats(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """Minimum, quartiles and maximum per group.

    Equal values are counted first, so each group carries one entry per distinct value.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("_n"))
    quartiles = F.percentile(value, F.array(*[F.lit(q) for q in QUARTILES]), F.col("_n"))
    return (
        counted.groupBy(*by)
        .agg(F.min(value).alias("min"), quartiles.alias("_q"), F.max(value).alias("max"))
        .select(*by, "min", *_quartile_columns(F.col("_q")), "max")
    )


def describe(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, standard deviation, extremes and exact quartiles of an integral column, per group.

    Works on the counts of distinct values (text lengths: no more than the longest text).
    """
    known = df.filter(F.col(value).isNotNull())
    counted = known.groupBy(*by, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    v, n = F.col("_v").cast("double"), F.col("_n")
    totals = counted.groupBy(*by).agg(
        F.sum(n).alias("count"),
        F.sum(v * n).alias("_s"),
        F.sum(v * v * n).alias("_ss"),
        F.min("_v").alias("min"),
        F.max("_v").alias("max"),
        F.percentile("_v", F.array(*[F.lit(q) for q in QUARTILES]), n).alias("_q"),
    )
    count, total = F.col("count"), F.col("_s")
    variance = F.try_divide(F.col("_ss") - total * total / count, count - 1)
    return totals.select(
        *by,
        "count",
        (total / count).alias("mean"),
        F.sqrt(variance).alias("std"),
        "min",
        *_quartile_columns(F.col("_q")),
        "max",
    )


def histogram(df: DataFrame, value: str, bins: int = DEFAULT_BINS) -> DataFrame:
    """Counts in ``bins`` intervals of equal width; the largest value falls into the last one.

    The bounds are a scalar subquery over the counts of distinct values.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    bounds = counted.agg(F.struct(F.min("_v").alias("low"), F.max("_v").alias("high"))).scalar()
    low, high = bounds.getField("low"), bounds.getField("high")
    width = (high - low) / F.lit(float(bins))
    position = F.floor(F.try_divide(F.col("_v") - low, width)).cast("int")
    bin_no = F.when(position.isNull(), F.lit(0)).otherwise(F.least(position, F.lit(bins - 1)))
    return (
        counted.withColumn("bin", bin_no)
        .withColumn("bin_start", low + F.col("bin") * width)
        .groupBy("bin", "bin_start")
        .agg(F.sum("_n").alias("count"))
    )


def daily_sentiment_counts(df: DataFrame, date: str = "review_date") -> DataFrame:
    return df.groupBy("sentiment", date).agg(F.count("*").alias("count"))


def date_bounds(df: DataFrame, date: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.min(date).alias("first_day"), F.max(date).alias("last_day"))


def sample_quantiles(df: DataFrame, value: str, by: Sequence[str], quantiles: Sequence[float] = (0.1, 0.5, 0.9)) -> DataFrame:
    """Low, median and high value per group of sample paths."""
    wanted = F.percentile(value, F.array(*[F.lit(q) for q in quantiles]))
    return df.groupBy(*by).agg(wanted.alias("_q")).select(
        *by, *[F.col("_q")[i].alias(f"q{int(q * 100)}") for i, q in enumerate(quantiles)]
    )
