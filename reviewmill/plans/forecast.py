"""Forecasts that need no solver of their own: naive, forest on lags, backtests, quantile bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.columns import unit_hash
from reviewmill.operators.metrics import best_by_metric, regression_metrics
from reviewmill.operators.profiling import sample_quantiles
from reviewmill.operators.recommend import grid_combinations
from reviewmill.plans.diagnostics import series_arrays
from reviewmill.plans.panel import DAY, SERIES, TEST_DAYS, VALUE, backtest_folds, by_day, lag_columns, split_last_n
from reviewmill.session import cut_lineage

SEASON = 7
FOREST_SEED = 123
LAGS = 7
# Parameter lists of the forest search (depths within the limit of Spark ML).
FOREST_GRID = {"lags": [3, 7, 10], "trees": [1, 2, 3, 5], "depth": [5, 10, 30]}
STEPS_PER_CHECKPOINT = 15


def naive_forecast(panel: DataFrame, n_test: int | None = TEST_DAYS, season: int = 1) -> DataFrame:
    """For the last ``n_test`` days (None: all days), the actual value ``season`` days before."""
    guess = panel.withColumn("predicted", F.lag(VALUE, season).over(by_day()))
    if n_test is None:
        return guess.select(SERIES, DAY, VALUE, "predicted")
    return split_last_n(guess, n_test).filter(F.col("split") == "test").select(SERIES, DAY, VALUE, "predicted")


def fit_rf(panel: DataFrame, lags: int = LAGS, trees: int = 100, depth: int = 10, seed: int = FOREST_SEED) -> RandomForestRegressionModel:
    """One forest over all series of the panel, predicting a day from the ``lags`` days before."""
    names = [f"lag_{k}" for k in range(1, lags + 1)]
    rows = lag_columns(panel, lags).dropna("any", subset=[VALUE, *names])
    features = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=VALUE, predictionCol="_prediction", numTrees=trees, maxDepth=depth, seed=seed
    )
    return forest.fit(features.select("features", VALUE))


def last_values(panel: DataFrame, lags: int) -> DataFrame:
    """Per series the latest ``lags`` values, newest first, and the last day: the start of a forecast."""
    arrays = series_arrays(panel)
    newest_first = F.reverse(F.col("values"))
    return arrays.filter(F.size("values") >= lags).select(
        SERIES, F.element_at("days", -1).alias("origin"), F.slice(newest_first, 1, lags).alias("recent")
    )


def fold_starts(folded: DataFrame, lags: int) -> DataFrame:
    """The same for each fold of a backtest, with the actual days before the fold."""
    recent = F.reverse(F.collect_list(VALUE).over(by_day().rowsBetween(-lags, -1)))
    previous = F.lag("fold").over(by_day())
    first = F.col("fold").isNotNull() & (F.coalesce(F.col("_previous"), F.lit(-1)) != F.col("fold"))
    return (
        folded.withColumn("recent", recent)
        .withColumn("_previous", previous)
        .filter(first & (F.size("recent") == lags))
        .select(SERIES, "fold", F.date_sub(DAY, 1).alias("origin"), "recent")
    )


def recursive_forecast(model: RandomForestRegressionModel, starts: DataFrame, steps: int) -> DataFrame:
    """Several steps ahead, each prediction serving as a lag of the next.

    Steps follow one another; all starts advance together, one narrow row each.
    """
    lags = model.numFeatures
    keys = [c for c in starts.columns if c != "recent"]
    state = starts.withColumn("_path", F.array().cast("array<double>"))
    for step in range(1, steps + 1):
        scored = model.transform(state.withColumn("features", array_to_vector("recent")))
        newest = F.array(F.col("_prediction"))
        state = scored.select(
            *keys,
            F.concat(newest, F.slice("recent", 1, lags - 1)).alias("recent"),
            F.concat("_path", newest).alias("_path"),
        )
        if step % STEPS_PER_CHECKPOINT == 0 and step < steps:
            state = cut_lineage(state)
    # The outer generator keeps the optimizer from testing, and so computing, the path twice.
    rows = state.select(*keys, F.posexplode_outer("_path").alias("_step", "predicted"))
    return rows.select(
        *[k for k in keys if k != "origin"],
        F.date_add("origin", F.col("_step") + 1).alias(DAY),
        (F.col("_step") + 1).alias("step"),
        "predicted",
    )


def forecast_rf(panel: DataFrame, n_test: int = TEST_DAYS, lags: int = LAGS, trees: int = 100, depth: int = 10) -> DataFrame:
    """Train on all but the last ``n_test`` days, forecast those, next to the actual values."""
    marked = split_last_n(panel, n_test)
    train = marked.filter(F.col("split") == "train").drop("split")
    model = fit_rf(train, lags, trees, depth)
    predicted = recursive_forecast(model, last_values(train, lags), n_test)
    actual = marked.filter(F.col("split") == "test").select(SERIES, DAY, VALUE)
    return actual.join(predicted, [SERIES, DAY], "left").select(SERIES, DAY, VALUE, "predicted")


def backtest_naive(panel: DataFrame, initial: int | float, steps: int = TEST_DAYS) -> DataFrame:
    """Every day of a fold is forecast as the last actual value before the fold."""
    folded = backtest_folds(panel, initial, steps)
    before = F.when(F.col("fold") != F.coalesce(F.lag("fold").over(by_day()), F.lit(-1)), F.lag(VALUE).over(by_day()))
    carried = folded.withColumn("_before", before)
    predicted = F.last("_before", ignorenulls=True).over(by_day())
    return carried.withColumn("predicted", predicted).filter(F.col("fold").isNotNull()).select(
        SERIES, DAY, "fold", VALUE, "predicted"
    )


def backtest_rf(
    panel: DataFrame,
    initial: int | float,
    steps: int = TEST_DAYS,
    lags: int = LAGS,
    trees: int = 5,
    depth: int = 10,
    refit: bool = False,
    parallelism: int = 4,
) -> DataFrame:
    """Rolling-origin forecasts of the forest; days of a series with too few days before them have no prediction.

    Without refit one model, trained on the first ``initial`` days, forecasts all folds together.
    With refit each fold gets a model trained on all days before it; folds are fitted from a few threads and
    written, so neither the plan nor the loss of an executor grows with their number.
    """
    folded = backtest_folds(panel, initial, steps)
    starts = fold_starts(folded, lags)
    actual = folded.filter(F.col("fold").isNotNull())
    if not refit:
        model = fit_rf(folded.filter(F.col("fold").isNull()), lags, trees, depth)
        forecasts = recursive_forecast(model, starts, steps)
    else:
        last = folded.agg(F.max("fold")).first()[0]

        def forecast(fold: int) -> DataFrame:
            model = fit_rf(folded.filter(F.col("fold").isNull() | (F.col("fold") < fold)), lags, trees, depth)
            return cut_lineage(recursive_forecast(model, starts.filter(F.col("fold") == fold), steps), "fold")

        with ThreadPoolExecutor(parallelism) as pool:
            parts = list(pool.map(forecast, range(0 if last is None else last + 1)))
        if not parts:
            return actual.select(SERIES, DAY, "fold", VALUE, F.lit(None).cast("double").alias("predicted"))
        forecasts = reduce(DataFrame.unionByName, parts)
    return actual.join(forecasts, [SERIES, "fold", DAY], "left").select(SERIES, DAY, "fold", VALUE, "predicted")


def backtest_metrics(forecasts: DataFrame) -> DataFrame:
    """Errors per fold, and pooled over all folds (``fold`` null)."""
    per_fold = regression_metrics(forecasts, VALUE, "predicted", by=["fold"])
    pooled = regression_metrics(forecasts, VALUE, "predicted").withColumn("fold", F.lit(None).cast("int"))
    return per_fold.unionByName(pooled)


def grid_search_rf(
    panel: DataFrame, initial: int | float, steps: int = TEST_DAYS, grid: Mapping[str, Sequence] | None = None, parallelism: int = 8
) -> DataFrame:
    """Backtest errors per parameter combination, without refit. The panel should be written or persisted."""
    combinations = grid_combinations(dict(grid or FOREST_GRID))

    def score(params: dict) -> tuple:
        row = regression_metrics(backtest_rf(panel, initial, steps, **params), VALUE, "predicted").first()
        return (params["lags"], params["trees"], params["depth"], row.rmse, row.mae, row.mape, row.predictions, row.asked)

    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(score, combinations))
    schema = "lags int, trees int, depth int, rmse double, mae double, mape double, predictions bigint, asked bigint"
    return panel.sparkSession.createDataFrame(rows, schema)


def tuned_forest(
    panel: DataFrame,
    n_test: int = TEST_DAYS,
    initial: int | float = 0.5,
    grid: Mapping[str, Sequence] | None = None,
    parallelism: int = 8,
) -> DataFrame:
    """The last ``n_test`` days by the forest that the search before them found best.

    The search backtests all days but the last ones. Its winner (lags, trees and depth) is fitted on all of
    these days. The parameters stand next to each forecast. The panel should be written or persisted.
    """
    before = cut_lineage(split_last_n(panel, n_test).filter("split = 'train'").drop("split"), "before-test")
    errors = grid_search_rf(before, initial, n_test, grid, parallelism)
    best = best_by_metric(errors, "rmse", ["lags", "trees", "depth"]).first()
    found = forecast_rf(panel, n_test, best.lags, best.trees, best.depth)
    return found.withColumns({name: F.lit(best[name]) for name in ("lags", "trees", "depth")})


def quantile_bands(panel: DataFrame, steps: int = TEST_DAYS, samples: int = 100, season: int = SEASON, seed: int = 42) -> DataFrame:
    """Low, median and high forecast per step from resampled errors of the seasonal-naive forecast.

    A sample path continues the last season; every further season adds an error drawn, by a hash of
    series, sample and step, from the errors of the known days.
    """
    paths = sample_paths(panel, steps, samples, season, seed)
    return sample_quantiles(paths, VALUE, [SERIES, DAY, "step"])


def sample_paths(panel: DataFrame, steps: int, samples: int, season: int = SEASON, seed: int = 42) -> DataFrame:
    arrays = series_arrays(panel).filter(F.size("values") > season)
    size = F.size("values")
    errors = F.zip_with(
        F.slice("values", F.lit(season + 1), size - season), F.slice("values", F.lit(1), size - season), lambda a, b: a - b
    )
    known = arrays.select(
        SERIES,
        F.element_at("days", -1).alias("_last"),
        F.slice("values", -season, season).alias("_season"),
        errors.alias("_errors"),
    )

    def draw(step: Column) -> Column:
        place = F.concat_ws("|", F.col(SERIES), F.col("sample"), step)
        return F.get(F.col("_errors"), F.floor(unit_hash(place, seed) * F.size("_errors")).cast("int"))

    phase = F.pmod(F.col("step") - 1, F.lit(season))
    rounds = F.sequence(phase + 1, F.col("step"), F.lit(season))
    y = F.aggregate(rounds, F.get(F.col("_season"), phase), lambda total, step: total + draw(step))
    return (
        known.withColumn("sample", F.explode(F.sequence(F.lit(1), F.lit(samples))))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(steps))))
        .select(SERIES, F.date_add("_last", F.col("step")).alias(DAY), "step", "sample", y.alias(VALUE))
    )


def compare(forecasts: Mapping[str, DataFrame]) -> DataFrame:
    """Forecasts of several models as one table with a ``model`` column."""
    result = None
    for name, frame in forecasts.items():
        part = frame.select(F.lit(name).alias("model"), SERIES, DAY, VALUE, "predicted")
        result = part if result is None else result.unionByName(part)
    return result
