"""Metric tables, error measures, and the choice of the best parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.columns import MAPE_FLOOR


def metric_table(
    df: DataFrame,
    metrics: Mapping[str, Column],
    value_type: str = "double",
    position: str | None = None,
) -> DataFrame:
    """Named aggregates of ``df`` as rows ``(metric, value)``; one job, nothing collected.

    ``position`` adds a 1-based column that keeps the order of the mapping.
    """
    names = list(metrics)
    wide = df.agg(*[metrics[name].cast(value_type).alias(f"m{i}") for i, name in enumerate(names)])
    rows = []
    for i, name in enumerate(names):
        fields = [F.lit(name).alias("metric"), F.col(f"m{i}").alias("value")]
        if position:
            fields.insert(0, F.lit(i + 1).alias(position))
        rows.append(F.struct(*fields))
    return wide.select(F.inline(F.array(*rows)))


def percentage_error(actual: Column, predicted: Column, zero: str = "floor") -> Column:
    """Absolute error over the absolute actual value.

    A zero actual value is floored at machine epsilon, or with ``zero="null"`` left out.
    """
    size = F.abs(actual)
    base = F.greatest(size, F.lit(MAPE_FLOOR)) if zero == "floor" else F.nullif(size, F.lit(0.0))
    return F.abs(actual - predicted) / base


def regression_metrics(
    df: DataFrame,
    actual: str,
    predicted: str,
    by: Sequence[str] = (),
    zero: str = "floor",
) -> DataFrame:
    """RMSE, MAE, MAPE (a fraction), the number of scored rows and of rows asked for, per group, in one aggregation.

    A row with an actual value is asked for; without a prediction (null or not a number) it is not scored and
    has no part in the errors, but shows as the difference of the two numbers.
    """
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    p = F.when(~F.isnan(p), p)
    return df.groupBy(*by).agg(
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        F.avg(F.abs(y - p)).alias("mae"),
        F.avg(percentage_error(y, p, zero)).alias("mape"),
        F.count(y - p).alias("predictions"),
        F.count(y).alias("asked"),
    )


def accuracy(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    hit = (F.col(label) == F.col(predicted)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count("*").alias("scored"))


def best_by_metric(df: DataFrame, metric: str, keep: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The row with the lowest metric, per group.

    Equal or missing metrics are settled by the kept columns, so the answer does not depend on row order.
    """
    others = [c for c in keep if c != metric]
    lowest = F.min(F.struct(metric, *others))
    return (
        df.filter(F.col(metric).isNotNull() & ~F.isnan(F.col(metric).cast("double")))
        .groupBy(*by)
        .agg(lowest.alias("best"))
        .select(*by, "best.*")
    )


def param_grid(df: DataFrame, **lists: Sequence) -> DataFrame:
    """Every combination of the listed parameter values for every row of ``df``.

    The lists are literals that are unfolded next to each row: no join, no shuffle.
    """
    for name, values in lists.items():
        df = df.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return df
