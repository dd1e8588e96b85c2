"""The daily panel: one row per series and day.

A series never has more rows than the calendar has days in its range: reviews are counted per day,
with partial counts before the shuffle, ahead of anything that works on whole series. So a window or
an array per series stays small however many reviews a series has.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.columns import SENTIMENTS, safe_ln, safe_sqrt, sentiment_label, to_day

SERIES, DAY, VALUE = "series_id", "ds", "y"
TEST_DAYS = 30


def by_day(series: str = SERIES, day: str = DAY) -> Window:
    return Window.partitionBy(series).orderBy(day)


def label_reviews(reviews: DataFrame) -> DataFrame:
    """Day and sentiment of each review; rows without one of them are dropped."""
    rating = F.col("star_rating").try_cast("float")
    labelled = reviews.withColumn("ds", to_day(F.col("review_date"))).withColumn("sentiment", sentiment_label(rating))
    return labelled.dropna("any", subset=["ds", "sentiment"])


def series_key(by: Sequence[str]) -> Column:
    """Name of a series from its grouping columns."""
    return F.concat_ws("/", *by) if by else F.lit("all")


def wide_counts(reviews: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Reviews per series, day and sentiment side by side; no review means null. One shuffle."""
    labelled = label_reviews(reviews).withColumn(SERIES, series_key(by))
    counts = [
        F.nullif(F.count_if(F.col("sentiment") == name), F.lit(0)).alias(f"{name}_count") for name in SENTIMENTS
    ]
    return labelled.groupBy(SERIES, DAY).agg(*counts)


def pivot_series(counts: DataFrame, date_column: str = "review_date") -> DataFrame:
    """Counts ``(sentiment, date, count)`` turned into one column per sentiment."""
    wide = counts.groupBy(date_column).pivot("sentiment", list(SENTIMENTS)).agg(F.sum("count"))
    return wide.withColumnsRenamed({name: f"{name}_count" for name in SENTIMENTS})


def outer_join_series(counts: DataFrame, date_column: str = "review_date") -> DataFrame:
    """The same by full outer joins of one table per sentiment."""
    parts = [
        counts.filter(F.col("sentiment") == name).select(date_column, F.col("count").alias(f"{name}_count"))
        for name in SENTIMENTS
    ]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.join(part, date_column, "full")
    return joined


def fill_days(df: DataFrame, series: str = SERIES, day: str = DAY) -> DataFrame:
    """Every day between the first and the last of a series; added days hold nulls.

    Each row is unfolded up to the day before the next row: no second read, no join.
    """
    last = F.coalesce(F.date_sub(F.lead(day).over(by_day(series, day)), 1), F.col(day))
    others = [c for c in df.columns if c not in (series, day)]
    unfolded = df.withColumn("_last", last).select(
        "*", F.posexplode(F.sequence(F.col(day), F.col("_last"))).alias("_pos", "_day")
    )
    kept = [F.when(F.col("_pos") == 0, F.col(c)).alias(c) for c in others]
    return unfolded.select(series, F.col("_day").alias(day), *kept)


def derive_gap_year(df: DataFrame) -> DataFrame:
    return df.withColumn("gap", F.col("positive_count") - F.col("negative_count")).withColumn("year", F.year(DAY))


def build_panel(
    reviews: DataFrame,
    by: Sequence[str] = (),
    start_after: date | str | None = None,
    fill: int | None = None,
) -> DataFrame:
    """Reviews to a gap-free daily panel with counts per sentiment, gap and year.

    Missing counts stay null, and so does the gap if either side is; ``fill=0`` sets them to zero.
    ``start_after`` keeps later days only.
    """
    return panel_of_counts(wide_counts(reviews, by), start_after, fill)


def panel_of_counts(counts: DataFrame, start_after: date | str | None = None, fill: int | None = None) -> DataFrame:
    """The panel from counts per series and day that are there already (:func:`wide_counts`)."""
    panel = fill_days(counts)
    if fill is not None:
        panel = panel.fillna(fill, subset=[f"{name}_count" for name in SENTIMENTS])
    panel = derive_gap_year(panel)
    if start_after is not None:
        panel = panel.filter(F.col(DAY) > F.lit(start_after).cast("date"))
    return panel


def count_panel(reviews: DataFrame, by: Sequence[str] = ("category",), fill: float | None = 0.0) -> DataFrame:
    """Long panel ``(series_id, ds, y)`` of all reviews per day."""
    daily = (
        label_reviews(reviews)
        .groupBy(series_key(by).alias(SERIES), DAY)
        .agg(F.count("*").cast("double").alias(VALUE))
    )
    panel = fill_days(daily)
    return panel if fill is None else panel.fillna(fill, subset=[VALUE])


def measure(panel: DataFrame, column: str = "gap", missing: str = "error") -> DataFrame:
    """One column of a panel as ``(series_id, ds, y)`` with nulls settled for model use.

    ``missing`` is ``zero``, ``drop``, or ``error`` to stop the job at the first null.
    """
    y = F.col(column).cast("double")
    long = panel.select(SERIES, DAY, y.alias(VALUE))
    if missing == "zero":
        return long.fillna(0.0, subset=[VALUE])
    if missing == "drop":
        return long.filter(F.col(VALUE).isNotNull())
    if missing == "error":
        stop = F.raise_error(F.concat(F.lit("no value for series "), F.col(SERIES))).cast("double")
        return long.withColumn(VALUE, F.coalesce(F.col(VALUE), stop))
    raise ValueError(f"unknown missing {missing!r}")


def transform(panel: DataFrame, value: str = VALUE) -> DataFrame:
    """Logarithm and square root, null where undefined."""
    return panel.withColumn(f"{value}_ln", safe_ln(F.col(value))).withColumn(f"{value}_sqrt", safe_sqrt(F.col(value)))


def _difference(order: int, value: str) -> Column:
    """An n-th difference as a sum of n + 1 lags (columns ``_lag_k``) with binomial weights."""
    total = F.col(value)
    for k in range(1, order + 1):
        total = total + F.col(f"_lag_{k}") * float((-1) ** k * comb(order, k))
    return total


def diffs(panel: DataFrame, orders: Sequence[int], value: str = VALUE) -> DataFrame:
    """Differences of several orders in one window pass, long: ``(series_id, ds, order, y)``.

    The first ``order`` days of a series have no difference and are dropped.
    """
    lags = {f"_lag_{k}": F.lag(value, k).over(by_day()) for k in range(1, max(orders) + 1)}
    rows = [F.struct(F.lit(n).alias("order"), _difference(n, value).alias(VALUE)) for n in orders]
    # The outer generator keeps the optimizer from testing, and so computing, the array twice.
    return panel.withColumns(lags).select(SERIES, DAY, F.inline_outer(F.array(*rows))).filter(F.col(VALUE).isNotNull())


def diff(panel: DataFrame, order: int = 1, value: str = VALUE) -> DataFrame:
    """Difference of one order."""
    return diffs(panel, [order], value).drop("order")


def lag_columns(panel: DataFrame, lags: int, value: str = VALUE) -> DataFrame:
    return panel.withColumns({f"lag_{k}": F.lag(value, k).over(by_day()) for k in range(1, lags + 1)})


def split_last_n(panel: DataFrame, n: int = TEST_DAYS) -> DataFrame:
    """The last ``n`` days of each series are the test."""
    latest_first = Window.partitionBy(SERIES).orderBy(F.col(DAY).desc())
    label = F.when(F.row_number().over(latest_first) <= n, F.lit("test")).otherwise(F.lit("train"))
    return panel.withColumn("split", label)


def split_last_twice(panel: DataFrame, validation: int = TEST_DAYS, test: int = TEST_DAYS) -> DataFrame:
    """Last ``test`` days are the test, the ``validation`` days before them the validation."""
    place = F.row_number().over(Window.partitionBy(SERIES).orderBy(F.col(DAY).desc()))
    label = F.when(place <= test, F.lit("test")).when(place <= test + validation, F.lit("validation"))
    return panel.withColumn("split", label.otherwise(F.lit("train")))


def scale_minmax(panel: DataFrame, leaky: bool = False, value: str = VALUE) -> DataFrame:
    """Scale to [0, 1] per series by the bounds of the training rows (all rows if ``leaky``)."""
    seen = F.col(value) if leaky else F.when(F.col("split") == "train", F.col(value))
    series = Window.partitionBy(SERIES)
    bounded = panel.withColumn("low", F.min(seen).over(series)).withColumn("high", F.max(seen).over(series))
    return bounded.withColumn("scaled", F.try_divide(F.col(value) - F.col("low"), F.col("high") - F.col("low")))


def unscale_minmax(df: DataFrame, column: str) -> Column:
    return df[column] * (df["high"] - df["low"]) + df["low"]


def sequences(panel: DataFrame, length: int = 8, train_fraction: float = 0.8, scale: bool = True, leaky: bool = False) -> DataFrame:
    """Sliding windows of ``length`` values with the next value as target.

    The first trunc(train_fraction x windows) windows train. Scaling bounds come from the rows that
    training windows see, unless ``leaky``.
    """
    series = Window.partitionBy(SERIES)
    windows = F.count("*").over(series) - length
    train_windows = F.floor(windows * train_fraction)
    place = F.row_number().over(by_day())
    marked = panel.withColumn("_train", train_windows).withColumn("_place", place)
    role = F.when(F.col("_place") <= F.col("_train") + length, F.lit("train")).otherwise(F.lit("test"))
    marked = marked.withColumn("split", role)
    source = VALUE
    if scale:
        marked, source = scale_minmax(marked, leaky), "scaled"
    frame = by_day().rowsBetween(-length, -1)
    return (
        marked.withColumn("window", F.collect_list(source).over(frame))
        .withColumn("target", F.col(source))
        .filter(F.size("window") == length)
        .select(SERIES, DAY, "window", "target", "split", *(["low", "high"] if scale else []))
    )


def initial_days(n: Column, initial: int | float) -> Column:
    """Days of a series of ``n`` days that come before the first fold: a number, or a share below 1 of the series."""
    if isinstance(initial, int):
        return F.lit(initial)
    if not 0 < initial < 1:
        raise ValueError(f"{initial} is neither a whole number nor a share")
    return F.greatest(F.lit(1), F.floor(n * F.lit(initial)).cast("int"))


def backtest_folds(panel: DataFrame, initial: int | float, steps: int = TEST_DAYS) -> DataFrame:
    """Number the days after the first ``initial`` ones by folds of ``steps`` days; earlier days get no fold.

    With a share in place of a number, every series of two days or more has folds, however short it is.
    """
    place = F.row_number().over(by_day())
    first = initial_days(F.count("*").over(Window.partitionBy(SERIES)), initial)
    fold = F.when(F.col("_place") > F.col("_first"), F.floor((F.col("_place") - F.col("_first") - 1) / steps).cast("int"))
    return panel.withColumns({"_place": place, "_first": first}).withColumn("fold", fold).drop("_place", "_first")
