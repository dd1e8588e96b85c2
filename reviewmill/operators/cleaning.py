"""Projections, filters and the cleaning chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.columns import all_present, is_true
from reviewmill.operators.metrics import metric_table
from reviewmill.sources.readers import REVIEW_COLUMNS

MIN_REVIEWS = 3
HISTORY_COLUMNS = ("product_id", "product_title", "product_category", "star_rating")
# Names of the steps in the cleaning report.
FUNNEL_STEPS = (
    "Total Records",
    "Filtered Records (No Nulls)",
    "Verified Records",
    "Customers with three or more reviews count",
)


def project_columns(df: DataFrame, columns: Sequence[str] = REVIEW_COLUMNS) -> DataFrame:
    return df.select(*columns)


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def rename_prefix(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Put ``prefix`` before every column name except those in ``keep``."""
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keep})


def drop_nulls(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(subset) if subset else None)


def cast_types(df: DataFrame) -> DataFrame:
    """Rating as float and customer as a 64-bit number; text that does not parse becomes null."""
    return df.withColumns(
        {
            "star_rating": F.col("star_rating").try_cast("float"),
            "customer_id": F.col("customer_id").try_cast("bigint"),
        }
    )


def filter_verified(df: DataFrame, column: str = "verified_purchase") -> DataFrame:
    return df.filter(is_true(F.col(column)))


def active_keys(df: DataFrame, key: str, n: int = MIN_REVIEWS) -> DataFrame:
    """The keys with at least ``n`` rows. Counting combines before the shuffle, so a hot key is cheap."""
    return df.groupBy(key).agg(F.count("*").alias("_rows")).filter(F.col("_rows") >= n).select(key)


def min_activity(df: DataFrame, key: str, n: int = MIN_REVIEWS) -> DataFrame:
    """Rows of keys that have at least ``n`` rows.

    A semi join against the qualifying keys rather than a count window: the join of a hot key is
    split by adaptive execution, a window group never is.
    """
    return filter_in_ids(df, active_keys(df, key, n), key)


def filter_in_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among ``ids``; ids never pass through the driver."""
    return df.join(ids.select(key), key, "left_semi")


def prepare_reviews(df: DataFrame) -> DataFrame:
    """Project, cast, drop incomplete rows, keep verified purchases: all narrow, in one stage.

    Casting comes before the null test, so that a rating that is no number counts as missing.
    """
    return filter_verified(drop_nulls(cast_types(project_columns(df)), REVIEW_COLUMNS))


def clean_reviews(df: DataFrame, min_reviews: int = MIN_REVIEWS) -> DataFrame:
    return min_activity(prepare_reviews(df), "customer_id", min_reviews)


def cleaning_funnel(df: DataFrame, min_reviews: int = MIN_REVIEWS) -> DataFrame:
    """Rows left after each cleaning step, as ``(step, metric, value)``.

    One scan: the steps are counted per customer, then summed; the last step keeps the customers
    whose verified count is large enough.
    """
    typed = cast_types(project_columns(df))
    complete = all_present(REVIEW_COLUMNS)
    verified = complete & is_true(F.col("verified_purchase"))
    per_customer = typed.groupBy("customer_id").agg(
        F.count("*").alias("total"),
        F.count_if(complete).alias("complete"),
        F.count_if(verified).alias("verified"),
    )
    kept = F.when(F.col("verified") >= min_reviews, F.col("verified")).otherwise(0)
    values = [F.sum("total"), F.sum("complete"), F.sum("verified"), F.sum(kept)]
    return metric_table(
        per_customer,
        {name: F.coalesce(value, F.lit(0)) for name, value in zip(FUNNEL_STEPS, values)},
        value_type="bigint",
        position="step",
    )


def funnel_removed(funnel: DataFrame) -> DataFrame:
    """Rows each step removed. Works on the few rows of a funnel."""
    steps = F.collect_list(F.struct("step", "metric", "value"))
    ordered = funnel.agg(F.array_sort(steps).alias("steps"))
    pairs = F.zip_with(
        F.slice("steps", 2, F.size("steps") - 1),
        F.slice("steps", 1, F.size("steps") - 1),
        lambda later, earlier: F.struct(
            later["step"].alias("step"),
            later["metric"].alias("metric"),
            (earlier["value"] - later["value"]).alias("removed"),
        ),
    )
    return ordered.select(F.inline(pairs))


def join_qualifying(df: DataFrame, key: str, n: int = MIN_REVIEWS) -> DataFrame:
    """Rows of active keys by an inner join, with the number of rows of the key attached."""
    counts = df.groupBy(key).agg(F.count("*").alias("key_rows")).filter(F.col("key_rows") >= n)
    return df.join(counts, key, "inner")


def user_history(
    splits: DataFrame,
    users: DataFrame,
    columns: Sequence[str] = HISTORY_COLUMNS,
) -> DataFrame:
    """What the given customers bought, per split."""
    return filter_in_ids(splits, users, "customer_id").select("customer_id", "split", *columns)


def schema_report(df: DataFrame) -> DataFrame:
    """Name, type and number of non-null values of each column, from one pass."""
    types = dict(df.dtypes)
    counts = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(df.columns)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(c).alias("column_name"),
                F.lit(types[c]).alias("type"),
                F.col(f"n{i}").alias("non_null"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select(F.inline(rows))
