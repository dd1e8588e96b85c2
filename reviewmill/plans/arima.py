"""ARIMA per series: differencing, least squares on lags and innovations, recursion.

Spark spreads series and chunks of orders over the cluster; each row holds the values of the series once.
The estimator is the two-stage regression of Hannan and Rissanen (1982), not maximum likelihood, so
coefficients differ a little from likelihood fits. Both stages are regressions on lags of the same
series, so the cross products of all lags are summed once per differenced series: every order is a part of
them, and the next day adds one product (:class:`Moments`). Seasonal terms enter as extra lags (an
additive lag set), not as a product of polynomials.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.operators.metrics import best_by_metric, param_grid, percentage_error
from reviewmill.plans.diagnostics import series_arrays
from reviewmill.plans.panel import DAY, SERIES, TEST_DAYS, VALUE, initial_days, split_last_n
from reviewmill.session import cut_lineage

ORDER = ["p", "d", "q"]
SEASONAL = ["sp", "sd", "sq", "season"]
NO_SEASON = (0, 0, 0, 1)
# The seasonal order in use.
CHOSEN_ORDER, CHOSEN_SEASONAL = (0, 1, 3), (2, 0, 0, 7)
LONG_HORIZON = 365
# A task row holds one series and up to so many orders.
ORDERS_PER_ROW = 32
# Innovations are followed through so many days before a forecast.
INNOVATION_DAYS = 64

# Send the functions below to the workers by value, so that they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _lag_set(short: int, seasonal: int, season: int) -> list[int]:
    return sorted({*range(1, short + 1), *(season * i for i in range(1, seasonal + 1))})


class Moments:
    """Cross products of a series with its own lags, from which any order is fitted on any day.

    ``products`` sums, over the days from ``reach`` on, the products of all pairs of ``1, w[t], w[t-1], ...,
    w[t-reach]``. A further day adds one product of such a row with itself. The regression of an order is
    a part of the sums, with the few days before ``reach`` that it may use added, so its cost depends on its
    lags and not on the length of the series.
    """

    def __init__(self, w: np.ndarray, reach: int):
        self.w, self.reach, self.n = w, reach, 0
        self.products = np.zeros((reach + 2, reach + 2))
        self._heads: dict[int, np.ndarray] = {}

    def _sum(self, first: int, last: int, lags: int) -> np.ndarray:
        if last <= first:
            return np.zeros((lags + 2, lags + 2))
        rows = np.column_stack([np.ones(last - first), *(self.w[first - k : last - k] for k in range(lags + 1))])
        return rows.T @ rows

    def advance(self, n: int) -> None:
        """Take in the days before day ``n``."""
        self.products += self._sum(max(self.n, self.reach), n, self.reach)
        self.n = max(self.n, n)

    def block(self, start: int) -> np.ndarray:
        """The products of the lags up to ``start`` over the days from ``start`` on."""
        if self.n < self.reach:
            return self._sum(start, self.n, start)
        if start not in self._heads:
            self._heads[start] = self._sum(start, self.reach, start)
        return self.products[: start + 2, : start + 2] + self._heads[start]


def _solve(gram: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least squares from cross products; directions in which the regressors do not vary get no weight."""
    size = np.sqrt(np.maximum(np.diag(gram), 0.0))
    size[size == 0] = 1.0
    values, vectors = np.linalg.eigh(gram / np.outer(size, size))
    good = values > 1e-13 * max(values[-1], 0.0) if len(values) else np.zeros(0, dtype=bool)
    return vectors[:, good] @ ((vectors[:, good].T @ (right / size)) / values[good]) / size


def _long_order(n: int, lags: list[int]) -> int:
    """Lags of the autoregression whose residuals stand for the innovations."""
    return max(math.ceil(10 * math.log10(n)), max(lags) + 1)


def _reach(n: int, ar: list[int], ma: list[int]) -> int:
    """The first day of the regression, which is its longest lag."""
    return _long_order(n, ar + ma) + max(ar + ma) if ma else max(ar, default=0)


def _fit(moments: Moments, ar: list[int], ma: list[int], constant: bool, long: dict) -> tuple[float, np.ndarray, np.ndarray]:
    """Constant, autoregressive and moving-average coefficients; ``long`` keeps the day's long autoregressions."""
    n, start = moments.n, _reach(moments.n, ar, ma)
    if n - start <= len(ar) + len(ma) + int(constant):
        raise ValueError("series too short for the order")
    block = moments.block(start)
    # Each regressor as a combination of 1, w[t], w[t-1], ...; an innovation is a residual, hence one, too.
    basis = np.zeros((start + 2, int(constant) + len(ar) + len(ma)))
    basis[0, : int(constant)] = 1.0
    for j, lag in enumerate(ar, int(constant)):
        basis[1 + lag, j] = 1.0
    if ma:
        order = _long_order(n, ar + ma)
        if n - order <= order + 1:
            raise ValueError("series too short for the innovations")
        if order not in long:
            first = moments.block(order)
            rest = [0, *range(2, order + 2)]
            long[order] = _solve(first[np.ix_(rest, rest)], first[rest, 1])
        for j, lag in enumerate(ma, int(constant) + len(ar)):
            basis[0, j] = -long[order][0]
            basis[1 + lag, j] = 1.0
            basis[2 + lag : 2 + lag + order, j] = -long[order][1:]
    beta = _solve(basis.T @ block @ basis, basis.T @ block[:, 1])
    first = int(constant)
    return float(beta[0]) if constant else 0.0, beta[first : first + len(ar)], beta[first + len(ar) :]


def fit_coefficients(w: np.ndarray, ar: list[int], ma: list[int], constant: bool) -> tuple[float, np.ndarray, np.ndarray]:
    """Constant, autoregressive and moving-average coefficients for the given lag sets."""
    moments = Moments(w, _reach(len(w), ar, ma))
    moments.advance(len(w))
    return _fit(moments, ar, ma, constant, {})


def _recent_innovations(w: np.ndarray, n: int, ar: list[int], ma: list[int], fit: tuple, long: np.ndarray) -> list[float]:
    """The innovations of the last days, as many as the moving average looks back.

    They follow from the fitted model over the last ``INNOVATION_DAYS`` days, beginning with residuals of the
    long autoregression; where the moving average cannot be inverted, from that autoregression alone.
    """
    (constant, phi, theta), back, order = fit, max(ma), len(long) - 1
    companion = np.zeros((back, back))
    companion[0, np.array(ma) - 1] = -theta
    companion[1:, :-1] += np.eye(back - 1)
    stable = np.abs(np.linalg.eigvals(companion)).max() < 1
    first = max(order + back, n - INNOVATION_DAYS) if stable else n
    lagged = np.lib.stride_tricks.sliding_window_view(w[first - back - order : first], order + 1)
    errors = (lagged[:, -1] - long[0] - lagged[:, -2::-1] @ long[1:]).tolist()
    for t in range(first, n):
        expected = constant + sum(c * w[t - k] for k, c in zip(ar, phi)) + sum(c * errors[-k] for k, c in zip(ma, theta))
        errors.append(w[t] - expected)
    return errors[-back:]


def _path(w: np.ndarray, n: int, ar: list[int], ma: list[int], fit: tuple, errors: list[float], steps: int) -> list[float]:
    constant, phi, theta = fit
    values = w[n - max(ar, default=0) : n].tolist()
    errors = list(errors)
    for _ in range(steps):
        values.append(constant + sum(c * values[-k] for k, c in zip(ar, phi)) + sum(c * errors[-k] for k, c in zip(ma, theta)))
        errors.append(0.0)
    return values[-steps:]


def forecast_paths(y: np.ndarray, orders: Sequence[Sequence[int]], origins: Sequence[int], steps: int) -> list[list[np.ndarray]]:
    """For each order and origin, the next ``steps`` values from the values before the origin.

    The cross products of each differenced series are built once, for all orders, and carried from
    origin to origin. NaN where a fit fails or explodes.
    """
    failed = np.full(steps, np.nan)
    found = [[failed] * len(origins) for _ in orders]
    kinds: dict[tuple, list[int]] = {}
    for i, (_, d, _, _, sd, _, season) in enumerate(orders):
        kinds.setdefault((d, sd, season if sd else 1), []).append(i)
    for (d, sd, season), members in kinds.items():
        levels, w = [], y
        for gap in [1] * d + [season] * sd:
            levels.append((gap, w))
            w = w[gap:] - w[:-gap] if len(w) > gap else w[:0]
        lost, constant = len(y) - len(w), d + sd == 0
        known = [o - lost for o in origins if o - lost > 0]
        if not known:
            continue
        lags = {i: (_lag_set(orders[i][0], orders[i][3], orders[i][6]), _lag_set(orders[i][2], orders[i][5], orders[i][6])) for i in members}
        # Centred and scaled, the cross products keep their digits.
        shift = float(w[: known[0]].mean()) if constant else 0.0
        scale = float(np.abs(w[: known[0]] - shift).max()) or 1.0
        w = (w - shift) / scale
        moments = Moments(w, min(max(_reach(max(known), *lags[i]) for i in members), max(known)))
        for place in sorted(range(len(origins)), key=lambda k: origins[k]):
            n = origins[place] - lost
            if n <= 0:
                continue
            moments.advance(n)
            long: dict[int, np.ndarray] = {}
            for i in members:
                ar, ma = lags[i]
                try:
                    fit = _fit(moments, ar, ma, constant, long)
                    errors = _recent_innovations(w, n, ar, ma, fit, long[_long_order(n, ar + ma)]) if ma else []
                    path = np.array(_path(w, n, ar, ma, fit, errors, steps)) * scale + shift
                except (ValueError, OverflowError, np.linalg.LinAlgError):
                    continue
                for back, (gap, level) in enumerate(reversed(levels), 1):
                    before = sum(g for g, _ in levels[: len(levels) - back])
                    tail = list(level[: origins[place] - before][-gap:])
                    for value in path:
                        tail.append(tail[-gap] + value)
                    path = np.asarray(tail[gap:])
                if np.isfinite(path).all():
                    found[i][place] = path
    return found


def forecast_values(y: np.ndarray, order: Sequence[int], seasonal: Sequence[int], steps: int) -> np.ndarray:
    """Fit on ``y`` and forecast ``steps`` values; NaN where the fit fails or explodes."""
    return forecast_paths(np.asarray(y, dtype=float), [(*order, *seasonal)], [len(y)], steps)[0][0]


@F.pandas_udf(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))
def _forecasts(values: pd.Series, orders: pd.Series, origins: pd.Series, steps: pd.Series) -> pd.Series:
    """For each row, order and origin, the forecast of the next steps from the values before the origin."""
    rows = zip(values, orders, origins, steps)
    return pd.Series(
        [
            forecast_paths(np.asarray(y, dtype=float), [[int(v) for v in o] for o in chosen], [int(v) for v in places], int(ahead))
            for y, chosen, places, ahead in rows
        ]
    )


def with_orders(series: DataFrame, orders: Iterable[tuple] | DataFrame, seasonal: tuple | None = None) -> DataFrame:
    """One row per series and up to ``ORDERS_PER_ROW`` orders.

    ``orders`` holds (p, d, q) or (p, d, q, P, D, Q, m) for all series, or is a table of each series' own orders
    with the columns ``p, d, q`` and, if seasonal, ``sp, sd, sq, season``; series without a row in it are left out.
    """
    if isinstance(orders, DataFrame):
        defaults = dict(zip(SEASONAL, seasonal or NO_SEASON))
        parts = [F.col(c) if c in orders.columns else F.lit(defaults[c]) for c in (*ORDER, *SEASONAL)]
        own = orders.groupBy(SERIES).agg(F.array_sort(F.collect_set(F.array(*[c.cast("int") for c in parts]))).alias("_own"))
        starts = F.sequence(F.lit(1), F.size("_own"), F.lit(ORDERS_PER_ROW))
        chunked = F.transform(starts, lambda i: F.slice("_own", i, F.lit(ORDERS_PER_ROW)))
        return series.join(own, SERIES).select(*series.columns, F.posexplode(chunked).alias("_chunk", "_orders"))
    full = [tuple(o) if len(o) == 7 else (*o, *(seasonal or NO_SEASON)) for o in orders]
    # Orders on the same differences stand together, as they share their cross products.
    full.sort(key=lambda o: (o[1], o[4], o[6], o))
    literal = [F.array(*[F.lit(int(v)) for v in o]) for o in full]
    chunks = [F.array(*literal[i : i + ORDERS_PER_ROW]) for i in range(0, len(literal), ORDERS_PER_ROW)]
    return series.select("*", F.posexplode(F.array(*chunks)).alias("_chunk", "_orders"))


def _run(series: DataFrame, origins: Column, steps: int, tasks: int | None = None) -> DataFrame:
    """Forecast rows: one per series, order, origin and step.

    The known days and values that a forecast is compared with are cut out of the series before anything is
    unfolded, so no row of the result carries a series.
    """
    rows = series.withColumn("_origins", origins).filter(F.size("_origins") > 0)
    # Fits cost far more than the few values that are moved. A stated number of partitions keeps
    # adaptive execution from packing the small rows into one task.
    tasks = tasks or int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(tasks, SERIES, "_chunk")
    targets = F.transform(
        "_origins",
        lambda o: F.struct(
            o.alias("origin"), F.slice("days", o + 1, F.lit(steps)).alias("days"), F.slice("values", o + 1, F.lit(steps)).alias("values")
        ),
    )
    solved = rows.select(
        SERIES,
        "_orders",
        targets.alias("_targets"),
        F.element_at("days", -1).alias("_last"),
        F.size("days").alias("_known"),
        _forecasts("values", "_orders", "_origins", F.lit(steps)).alias("_paths"),
    )
    # Outer generators: the plain ones would test the computed arrays first, and so fit twice.
    per_order = solved.select(
        SERIES, "_targets", "_last", "_known", F.inline_outer(F.arrays_zip(F.col("_orders").alias("order"), F.col("_paths").alias("paths")))
    )
    per_origin = per_order.select(
        SERIES, "order", "_last", "_known", F.inline_outer(F.arrays_zip(F.col("_targets").alias("target"), F.col("paths").alias("path")))
    )
    unfolded = per_origin.select(SERIES, "order", "_last", "_known", "target", F.posexplode_outer("path").alias("_step", "_predicted"))
    known = F.get("target.days", F.col("_step"))
    beyond = F.date_add("_last", (F.col("target.origin") + F.col("_step") - F.col("_known") + 1).cast("int"))
    return unfolded.select(
        SERIES,
        *[F.get("order", F.lit(i)).alias(name) for i, name in enumerate((*ORDER, *SEASONAL))],
        F.coalesce(known, beyond).alias(DAY),
        (F.col("_step") + 1).alias("step"),
        F.get("target.values", F.col("_step")).alias(VALUE),
        F.when(~F.isnan("_predicted"), F.col("_predicted")).alias("predicted"),
    )


def arima_rolling(
    panel: DataFrame, orders: Iterable[tuple] | DataFrame, n_test: int = TEST_DAYS, seasonal: tuple | None = None, tasks: int | None = None
) -> DataFrame:
    """Refit at each of the last ``n_test`` days on everything before it, forecast that day.

    ``orders`` may be a table with the orders of each series (:func:`with_orders`). ``tasks`` is the number of
    tasks that the fits are dealt to; by default the session's number of shuffle partitions.
    """
    origins = F.sequence(F.size("values") - n_test, F.size("values") - 1)
    series = series_arrays(panel).filter(F.size("values") > n_test)
    return _run(with_orders(series, orders, seasonal), origins, 1, tasks)


def arima_forecast(
    panel: DataFrame,
    orders: Iterable[tuple] | DataFrame,
    steps: int = TEST_DAYS,
    seasonal: tuple | None = None,
    holdout: bool = True,
    tasks: int | None = None,
) -> DataFrame:
    """Fit once and forecast ``steps`` days: the last known ones if ``holdout``, else those after the end."""
    known = F.size("values") - (steps if holdout else 0)
    series = series_arrays(panel).filter(known > 0)
    return _run(with_orders(series, orders, seasonal), F.array(known), steps, tasks)


def arima_backtest(
    panel: DataFrame,
    order: tuple,
    initial: int | float,
    steps: int = TEST_DAYS,
    seasonal: tuple | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Expanding folds of ``steps`` days after the first ``initial`` ones (a number or a share), refitted at each."""
    series = series_arrays(panel).withColumn("_first", initial_days(F.size("values"), initial)).filter(F.size("values") > F.col("_first"))
    origins = F.sequence(F.col("_first"), F.size("values") - 1, F.lit(steps))
    return _run(with_orders(series, [order], seasonal), origins, steps, tasks).filter(F.col(VALUE).isNotNull())


def order_errors(forecasts: DataFrame) -> DataFrame:
    """RMSE, MAE and MAPE per series and order; a fit that failed anywhere has infinite errors."""
    keys = [SERIES, *ORDER, *SEASONAL]
    y, p = F.col(VALUE), F.col("predicted")
    failed = F.count_if(p.isNull()) > 0
    infinite = F.lit(float("inf"))
    errors = {
        "rmse": F.sqrt(F.avg((y - p) * (y - p))),
        "mae": F.avg(F.abs(y - p)),
        "mape": F.avg(percentage_error(y, p)),
    }
    columns = [F.when(failed, infinite).otherwise(e).alias(n) for n, e in errors.items()]
    return forecasts.groupBy(*keys).agg(*columns, F.count("*").alias("predictions"))


def search_orders(
    p: Iterable[int], d: Iterable[int], q: Iterable[int], max_order: int | None = None, seasonal: Iterable[tuple] = (NO_SEASON,)
) -> list[tuple]:
    """All (p, d, q, P, D, Q, m) within the given ranges; ``max_order`` bounds p + q + P + Q."""
    return [
        (a, b, c, *s)
        for s in seasonal
        for a in p
        for b in d
        for c in q
        if max_order is None or a + c + s[0] + s[2] <= max_order
    ]


def arima_search(
    panel: DataFrame, orders: Iterable[tuple] | None = None, n_test: int = TEST_DAYS, rolling: bool = True, tasks: int | None = None
) -> DataFrame:
    """The order with the lowest RMSE per series, over the last ``n_test`` days.

    ``rolling`` refits at each day, otherwise one fit forecasts all days. By default p, d and q run
    from 0 to 2.
    """
    orders = list(orders or search_orders(range(3), range(3), range(3)))
    forecasts = arima_rolling(panel, orders, n_test, tasks=tasks) if rolling else arima_forecast(panel, orders, n_test, tasks=tasks)
    keep = [*ORDER, *SEASONAL, "mae", "mape", "predictions"]
    return best_by_metric(order_errors(forecasts), "rmse", keep, by=[SERIES])


def arima_auto_rolling(
    panel: DataFrame,
    orders: Iterable[tuple] | None = None,
    n_test: int = TEST_DAYS,
    n_search: int = TEST_DAYS,
    rolling: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Search the order of each series before the last ``n_test`` days, then roll over these days with it.

    The search scores the last ``n_search`` days before the test, by one fit per order or, if ``rolling``, by a
    refit at each day. The orders found are a table that is joined to the series, so each series has its own.
    A series for which no order could be fitted has no forecast.
    """
    before = split_last_n(panel, n_test).filter("split = 'train'").drop("split")
    found = cut_lineage(arima_search(before, orders, n_search, rolling, tasks), "orders")
    fitted = found.filter(F.col("rmse") < float("inf")).select(SERIES, *ORDER, *SEASONAL)
    return arima_rolling(panel, fitted, n_test, tasks=tasks)


def order_grid(panel: DataFrame, p: Sequence[int], d: Sequence[int], q: Sequence[int]) -> DataFrame:
    """The parameter combinations each series of a panel is tried with."""
    return param_grid(panel.select(SERIES).distinct(), p=p, d=d, q=q)
