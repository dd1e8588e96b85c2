"""Diagnostics and forecasts against brute force and simulated series."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill.operators.metrics import best_by_metric, regression_metrics
from reviewmill.plans import arima, diagnostics, forecast, panel

START = dt.date(2000, 1, 1)


def frame(spark, series: dict[str, np.ndarray]):
    rows = [(name, START + dt.timedelta(days=i), float(v)) for name, values in series.items() for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series_id string, ds date, y double")


@pytest.fixture(scope="module")
def simulated():
    rng = np.random.default_rng(7)
    noise = rng.normal(size=2000)
    ar = np.zeros(2000)
    for t in range(1, 2000):
        ar[t] = 0.7 * ar[t - 1] + noise[t]
    weekly = 20 + 5 * np.sin(2 * np.pi * np.arange(2000) / 7) + rng.normal(size=2000)
    return {"ar": ar, "walk": np.cumsum(rng.normal(size=2000)), "weekly": weekly}


@pytest.fixture(scope="module")
def panel_(spark, simulated):
    return frame(spark, simulated).cache()


def brute_adf(y):
    """Independent form: a least-squares fit per lag, all on the same rows, then a refit."""
    dy = np.diff(y)
    most = int(np.ceil(12 * (len(y) / 100) ** 0.25))

    def fit(lag, skip):
        target = dy[skip:]
        x = np.array([[1.0, y[t], *[dy[t - k] for k in range(1, lag + 1)]] for t in range(skip, len(dy))])
        beta, *_ = np.linalg.lstsq(x, target, rcond=None)
        e = target - x @ beta
        n, k = x.shape
        aic = n * np.log(e @ e / n) + 2 * k
        cov = np.linalg.inv(x.T @ x) * (e @ e) / (n - k)
        return aic, beta[1] / np.sqrt(cov[1, 1])

    best = min(range(most + 1), key=lambda lag: fit(lag, most)[0])
    return fit(best, best)[1], best


def test_adf_equals_brute_force(panel_, simulated):
    result = {r.series_id: r for r in diagnostics.adf(panel_).collect()}
    for name, y in simulated.items():
        stat, lag = brute_adf(y)
        assert result[name].adf_lag == lag
        assert result[name].adf == pytest.approx(stat, rel=1e-6)
    assert result["ar"].unit_root_rejected and not result["walk"].unit_root_rejected


@pytest.mark.parametrize("stat, p", [(-0.5283, 0.8864), (-14.9850, 1.147e-27), (-20.469, 0.0)])
def test_adf_p_value_equals_known_figures(stat, p):
    assert diagnostics.adf_p_value(stat) == pytest.approx(p, rel=1e-3)


def test_adf_critical_values_are_ordered(panel_):
    for row in diagnostics.adf(panel_).collect():
        assert row.crit_1 < row.crit_5 < row.crit_10 < 0


def test_stationarity_of_differences(panel_):
    result = {(r.series_id, r.order): r for r in diagnostics.stationarity(panel_).collect()}
    assert len(result) == 9
    assert result[("walk", 0)].kpss_p == pytest.approx(0.01)
    assert result[("walk", 1)].unit_root_rejected and result[("walk", 1)].kpss_p > 0.05


def test_pacf_of_an_autoregression_cuts_off(panel_):
    values = {r.lag: r for r in diagnostics.pacf(panel_, 10).filter("series_id = 'ar'").collect()}
    assert values[1].pacf == pytest.approx(0.7, abs=0.05)
    assert all(abs(values[k].pacf) < 0.08 for k in range(2, 11))


def test_acf_of_a_short_series(spark):
    rows = diagnostics.acf(frame(spark, {"s": np.array([1.0, 2.0, 4.0])}), 40).orderBy("lag").collect()
    m = 7 / 3
    c = [1 - m, 2 - m, 4 - m]
    ss = sum(v * v for v in c)
    assert [r.acf for r in rows] == pytest.approx([1.0, (c[0] * c[1] + c[1] * c[2]) / ss, c[0] * c[2] / ss])


def test_decompose_finds_the_week(panel_):
    parts = diagnostics.decompose(panel_.filter("series_id = 'weekly'")).filter("phase = 2").first()
    assert parts.seasonal == pytest.approx(5 * np.sin(2 * np.pi * 2 / 7), abs=0.3)


def test_decompose_refuses_even_periods(panel_):
    with pytest.raises(ValueError):
        diagnostics.decompose(panel_, period=6)


def test_arma_coefficients_are_recovered(simulated):
    _, phi, _ = arima.fit_coefficients(simulated["ar"], [1], [], True)
    assert phi[0] == pytest.approx(0.7, abs=0.05)
    rng = np.random.default_rng(11)
    e = rng.normal(size=2001)
    y = np.zeros(2001)
    for t in range(1, 2001):
        y[t] = 0.6 * y[t - 1] + e[t] + 0.4 * e[t - 1]
    _, phi, theta = arima.fit_coefficients(y[1:], [1], [1], True)
    assert phi[0] == pytest.approx(0.6, abs=0.1) and theta[0] == pytest.approx(0.4, abs=0.1)


def refitted(y: np.ndarray, order: tuple, steps: int) -> np.ndarray:
    """The two regressions by a least-squares fit on all days, and the recursion, without shared products."""
    p, d, q, sp, sd, sq, season = order
    levels, w = [], y
    for gap in [1] * d + [season] * sd:
        levels.append((gap, w))
        w = w[gap:] - w[:-gap]
    ar = sorted({*range(1, p + 1), *(season * i for i in range(1, sp + 1))})
    ma = sorted({*range(1, q + 1), *(season * i for i in range(1, sq + 1))})
    n, start = len(w), max(ar, default=0)
    residuals = np.full(n, np.nan)
    if ma:
        long = max(math.ceil(10 * math.log10(n)), max(ar + ma) + 1)
        x = np.array([[1.0, *(w[t - k] for k in range(1, long + 1))] for t in range(long, n)])
        residuals[long:] = w[long:] - x @ np.linalg.lstsq(x, w[long:], rcond=None)[0]
        start = long + max(ar + ma)
    constant = d + sd == 0
    x = np.array([[*([1.0] if constant else []), *(w[t - k] for k in ar), *(residuals[t - k] for k in ma)] for t in range(start, n)])
    beta = np.linalg.lstsq(x, w[start:], rcond=None)[0] if x.shape[1] else np.zeros(0)
    c, phi, theta = (beta[0] if constant else 0.0), beta[int(constant) : int(constant) + len(ar)], beta[int(constant) + len(ar) :]
    errors = residuals.copy()
    if ma:
        poly = np.zeros(max(ma) + 1)
        poly[0] = 1.0
        poly[ma] = theta
        if np.abs(np.roots(poly)).max() < 1:
            for t in range(max(long + max(ma), n - arima.INNOVATION_DAYS), n):
                errors[t] = w[t] - c - sum(b * w[t - k] for k, b in zip(ar, phi)) - sum(b * errors[t - k] for k, b in zip(ma, theta))
    values, errors = list(w), list(errors)
    for _ in range(steps):
        values.append(c + sum(b * values[-k] for k, b in zip(ar, phi)) + sum(b * errors[-k] for k, b in zip(ma, theta)))
        errors.append(0.0)
    path = values[-steps:]
    for gap, level in reversed(levels):
        tail = list(level[-gap:])
        for value in path:
            tail.append(tail[-gap] + value)
        path = tail[gap:]
    return np.array(path)


ORDERS = [(0, 0, 0), (1, 0, 0), (3, 0, 0), (2, 0, 1), (0, 1, 3), (2, 1, 2), (1, 2, 1), (0, 1, 3, 2, 0, 0, 7), (1, 0, 1, 1, 1, 1, 7)]


@pytest.mark.parametrize("order", ORDERS)
def test_shared_products_equal_refits(simulated, order):
    """Every order on every day from one table of products, against a fit of its own."""
    full = order if len(order) == 7 else (*order, *arima.NO_SEASON)
    others = [(*o, *arima.NO_SEASON) for o in ORDERS if len(o) == 3]
    for y in (simulated["ar"][:700] + 50, simulated["walk"][:300], simulated["weekly"][:400]):
        origins = [len(y) - 40, len(y) - 39, len(y) - 20, len(y) - 3]
        found = arima.forecast_paths(y, [*others, full], origins, 3)[-1]
        scale = np.abs(y).max()
        for place, path in zip(origins, found):
            assert path / scale == pytest.approx(refitted(y[:place], full, 3) / scale, abs=1e-8)


def test_short_series_use_only_known_days(simulated):
    """The table of products reaches further back than the first origins have days."""
    y = simulated["ar"][:60]
    orders = [(1, 0, 0, *arima.NO_SEASON), (1, 0, 1, *arima.NO_SEASON)]
    found = arima.forecast_paths(y, orders, [8, 25, 59], 1)
    for order, paths in zip(orders, found):
        for place, path in zip([8, 25, 59], paths):
            again = arima.forecast_paths(y[:place], [order], [place], 1)[0][0]
            assert path == pytest.approx(again, abs=1e-9, nan_ok=True)
    assert np.isfinite(found[0][0]).all() and np.isnan(found[1][0]).all()


def test_each_series_has_its_own_orders(spark, panel_):
    own = spark.createDataFrame([("ar", 1, 0, 0), ("walk", 0, 1, 0), ("walk", 1, 1, 0)], "series_id string, p int, d int, q int")
    rows = arima.arima_rolling(panel_, own, 4)
    counts = {(r.series_id, r.p, r.d, r.q): r["count"] for r in rows.groupBy("series_id", "p", "d", "q").count().collect()}
    assert counts == {("ar", 1, 0, 0): 4, ("walk", 0, 1, 0): 4, ("walk", 1, 1, 0): 4}
    shared = arima.arima_rolling(panel_.filter("series_id = 'ar'"), [(1, 0, 0)], 4)
    mine = {r.ds: r.predicted for r in rows.filter("series_id = 'ar'").collect()}
    assert mine == pytest.approx({r.ds: r.predicted for r in shared.collect()})
    seasonal = own.limit(1).selectExpr("series_id", "0 AS p", "0 AS d", "0 AS q", "0 AS sp", "1 AS sd", "0 AS sq", "7 AS season")
    assert {r.season for r in arima.arima_rolling(panel_, seasonal, 2).collect()} == {7}


def test_search_then_roll_sees_no_test_day(spark, simulated):
    """The order is found before the test: other test days change no order."""
    y, changed = simulated["weekly"][:300], simulated["weekly"][:300].copy()
    changed[-10:] = np.arange(10) * 100.0
    orders = [(0, 0, 0), (1, 0, 0), (0, 1, 0), (0, 0, 0, 0, 1, 0, 7)]
    rows = arima.arima_auto_rolling(frame(spark, {"a": y, "b": changed}), orders, 10, 20, tasks=3).collect()
    chosen = {s: {(r.p, r.d, r.q, r.sd, r.season) for r in rows if r.series_id == s} for s in "ab"}
    assert chosen["a"] == chosen["b"] and len(chosen["a"]) == 1 and len(rows) == 20


def test_forecast_of_a_trend_is_the_trend():
    path = arima.forecast_values(np.arange(100.0) * 2, (0, 2, 0), arima.NO_SEASON, 5)
    assert path == pytest.approx([200, 202, 204, 206, 208])


def test_seasonal_difference_repeats_the_season():
    season = np.tile([3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0], 20)
    path = arima.forecast_values(season, (0, 0, 0), (0, 1, 0, 7), 9)
    assert path == pytest.approx(list(season[:7]) + list(season[:2]))


def test_rolling_forecast_sees_only_the_past(spark):
    """Changing the last day changes no forecast."""
    y = np.sin(np.arange(200.0)) * 10
    changed = y.copy()
    changed[-1] = 500.0
    rows = arima.arima_rolling(frame(spark, {"a": y, "b": changed}), [(2, 0, 1)], 5)
    by_series = {s: [r.predicted for r in rows.filter(F.col("series_id") == s).orderBy("ds").collect()] for s in "ab"}
    assert by_series["a"] == pytest.approx(by_series["b"])


def test_forecast_rows_and_days(panel_, simulated):
    rows = arima.arima_forecast(panel_, [(1, 0, 0), (0, 1, 1)], 30, holdout=False)
    assert rows.count() == len(simulated) * 2 * 30
    bounds = rows.agg(F.min("ds"), F.max("ds")).first()
    assert bounds[0] == START + dt.timedelta(days=2000) and bounds[1] == START + dt.timedelta(days=2029)


def test_failing_order_has_infinite_error(spark):
    short = frame(spark, {"s": np.arange(20.0) % 3})
    rows = arima.order_errors(arima.arima_rolling(short, [(0, 0, 0), (9, 2, 9)], 3))
    errors = {r.p: r.rmse for r in rows.collect()}
    assert errors[9] == float("inf") and np.isfinite(errors[0])
    best = best_by_metric(rows, "rmse", ["p", "d", "q"], ["series_id"]).first()
    assert best.p == 0


def test_search_prefers_the_true_order(panel_):
    best = {r.series_id: r for r in arima.arima_search(panel_, arima.search_orders(range(2), range(2), [0])).collect()}
    assert (best["ar"].p, best["ar"].d) == (1, 0)


def test_order_ranges():
    assert len(arima.search_orders(range(3), range(3), range(3))) == 27
    assert all(o[0] + o[2] <= 2 for o in arima.search_orders(range(3), range(1), range(3), max_order=2))


def test_forest_beats_naive_on_a_weekly_series(panel_):
    weekly = panel_.filter("series_id = 'weekly'")
    forest = regression_metrics(forecast.forecast_rf(weekly, 30, trees=10), "y", "predicted").first()
    naive = regression_metrics(forecast.naive_forecast(weekly, 30), "y", "predicted").first()
    assert forest.predictions == naive.predictions == 30
    assert forest.rmse < naive.rmse


def test_recursion_feeds_predictions_back(panel_):
    model = forecast.fit_rf(panel_, lags=3, trees=2, depth=4)
    starts = forecast.last_values(panel_, 3)
    rows = forecast.recursive_forecast(model, starts, 17)
    assert rows.count() == 3 * 17
    from pyspark.ml.linalg import Vectors

    for start in starts.collect():
        recent, expected = list(start.recent), []
        for _ in range(17):
            expected.append(model.predict(Vectors.dense(recent)))
            recent = [expected[-1], *recent[:-1]]
        got = [r.predicted for r in rows.filter(F.col("series_id") == start.series_id).orderBy("ds").collect()]
        assert got == pytest.approx(expected)


def test_backtest_starts_from_the_days_before_the_fold(panel_):
    folded = panel.backtest_folds(panel_, 1900, 30)
    starts = forecast.fold_starts(folded, 4)
    for row in starts.collect():
        known = folded.filter((F.col("series_id") == row.series_id) & (F.col("ds") <= row.origin)).orderBy(F.col("ds").desc())
        assert [r.y for r in known.limit(4).collect()] == row.recent
        assert (row.origin - START).days == 1900 + row.fold * 30 - 1


@pytest.mark.parametrize("refit", [False, True])
def test_backtest_covers_every_fold_day_once(panel_, refit):
    rows = forecast.backtest_rf(panel_, 1950, 30, lags=3, trees=2, depth=3, refit=refit)
    assert rows.count() == rows.select("series_id", "ds").distinct().count() == 3 * 50
    pooled = forecast.backtest_metrics(rows).filter("fold is null").first()
    assert pooled.predictions == 150


def test_same_seed_same_bands(panel_):
    first = forecast.quantile_bands(panel_, 5, 10).orderBy("series_id", "step").collect()
    second = forecast.quantile_bands(panel_.repartition(3), 5, 10).orderBy("series_id", "step").collect()
    assert first == second
    assert all(r.q10 <= r.q50 <= r.q90 for r in first)


def test_measure_settles_nulls(spark):
    rows = spark.createDataFrame([("s", START, None), ("s", START + dt.timedelta(days=1), 2)], "series_id string, ds date, gap long")
    assert [r.y for r in panel.measure(rows, missing="zero").orderBy("ds").collect()] == [0.0, 2.0]
    assert panel.measure(rows, missing="drop").count() == 1
    with pytest.raises(Exception, match="no value for series"):
        panel.measure(rows, missing="error").collect()


def test_scaling_bounds_come_from_training_days(spark):
    y = np.arange(20.0)
    marked = panel.split_last_n(frame(spark, {"s": y}), 5)
    row = panel.scale_minmax(marked).first()
    assert (row.low, row.high) == (0.0, 14.0)
    assert panel.scale_minmax(marked, leaky=True).first().high == 19.0


def test_known_unscaled_windows(spark):
    rows = panel.sequences(frame(spark, {"s": np.arange(12.0)}), 8, 0.5, scale=False).orderBy("ds").collect()
    assert [(r.window[0], r.target, r.split) for r in rows] == [
        (0.0, 8.0, "train"),
        (1.0, 9.0, "train"),
        (2.0, 10.0, "test"),
        (3.0, 11.0, "test"),
    ]


def test_folds_after_a_share_leave_no_series_out(spark):
    rows = frame(spark, {"long": np.arange(100.0), "short": np.arange(3.0), "one": np.arange(1.0)})
    folded = panel.backtest_folds(rows, 0.75, 10)
    folds = {s: [r.fold for r in folded.filter(F.col("series_id") == s).orderBy("ds").collect()] for s in ("long", "short", "one")}
    assert folds["long"] == [None] * 75 + [0] * 10 + [1] * 10 + [2] * 5
    assert folds["short"] == [None, None, 0] and folds["one"] == [None]
    naive = forecast.backtest_naive(rows, 0.75, 10)
    assert naive.groupBy("series_id").count().count() == 2 and naive.filter("predicted is null").count() == 0
    # A series with too few days for the lags keeps its days, without a prediction.
    forest = forecast.backtest_rf(rows, 0.75, 10, lags=7, trees=2, depth=3)
    assert {(r.series_id, r.predicted is None) for r in forest.collect()} == {("long", False), ("short", True)}
    fits = arima.arima_backtest(rows, (0, 1, 0), 0.75, 10)
    assert {r.series_id: r["count"] for r in fits.groupBy("series_id").count().collect()} == {"long": 25, "short": 1}
    with pytest.raises(ValueError):
        panel.backtest_folds(rows, 1.5)


def test_tuned_forest_is_the_winner_of_the_search(panel_):
    weekly = panel_.filter("series_id = 'weekly' and ds < '2001-01-01'").cache()
    grid = {"lags": [2, 7], "trees": [3], "depth": [2, 5]}
    found = forecast.tuned_forest(weekly, 20, 0.8, grid)
    train = panel.split_last_n(weekly, 20).filter("split = 'train'").drop("split")
    errors = sorted((r.rmse, r.lags, r.trees, r.depth) for r in forecast.grid_search_rf(train, 0.8, 20, grid).collect())
    rows = found.collect()
    assert len(rows) == 20 and {(r.lags, r.trees, r.depth) for r in rows} == {errors[0][1:]}
    assert all(r.predicted is not None for r in rows)
