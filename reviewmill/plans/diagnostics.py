"""Diagnostics of daily series: autocorrelation, decomposition, stationarity.

A series is one row with an array of its values (no longer than the calendar, see ``panel``); array
functions then work on it inside the JVM, with a single shuffle by series. Lags by the thousand are
products of one Fourier transform, as an Arrow-batched function.

Computed arrays are unfolded by the ``outer`` generators: the plain ones make the optimizer test the
size of the array first, which would compute it a second time. The arrays are never empty.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.functions.columns import vector_sum
from reviewmill.plans.panel import DAY, SERIES, VALUE, by_day, diffs

# 97.5% point of the normal distribution.
NORMAL_975 = 1.959963984540054
# Level-stationarity test, critical values and their probabilities.
KPSS_CRITICAL = (0.347, 0.463, 0.574, 0.739)
KPSS_PROBABILITY = (0.10, 0.05, 0.025, 0.01)
# Unit-root test with a constant, response surfaces of the critical values (MacKinnon 2010).
ADF_CRITICAL = {
    "crit_1": (-3.43035, -6.5393, -16.786, -79.433),
    "crit_5": (-2.86154, -2.8903, -4.234, -40.040),
    "crit_10": (-2.56677, -1.5384, -2.809, 0.0),
}
# Polynomials and limits of the p-value with a constant (MacKinnon 1994).
ADF_P_SMALL = (2.1659, 1.4412, 0.038269)
ADF_P_LARGE = (1.7339, 0.93202, -0.12745, -0.010368)
ADF_P_SWITCH, ADF_P_ZERO, ADF_P_ONE = -1.61, -18.83, 2.74

ADF_RESULT = T.StructType(
    [
        T.StructField("adf", T.DoubleType()),
        T.StructField("adf_p", T.DoubleType()),
        T.StructField("adf_lag", T.IntegerType()),
        T.StructField("adf_nobs", T.IntegerType()),
    ]
)
# Send the functions below to the workers by value, so that they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def series_arrays(panel: DataFrame, value: str = VALUE, keys: tuple[str, ...] = (SERIES,)) -> DataFrame:
    """One row per series with its days and values in order, and their mean."""
    points = F.array_sort(F.collect_list(F.struct(DAY, value)))
    ordered = panel.groupBy(*keys).agg(points.alias("_points"), F.avg(value).alias("mean"))
    return ordered.select(
        *keys,
        F.col(f"_points.{DAY}").alias("days"),
        F.col(f"_points.{value}").alias("values"),
        "mean",
    )


def _lag_product(centred: Column, lag: Column) -> Column:
    """Sum of products of values ``lag`` places apart, for few lags."""
    length = F.size(centred) - lag
    pairs = F.zip_with(F.slice(centred, lag + 1, length), F.slice(centred, F.lit(1), length), lambda a, b: a * b)
    return vector_sum(pairs)


def _with_centred(panel: DataFrame, value: str, keys: tuple[str, ...] = (SERIES,)) -> DataFrame:
    """Deviations from the mean of the series, in order."""
    arrays = series_arrays(panel.filter(F.col(value).isNotNull()), value, keys)
    centred = F.transform("values", lambda v: v - F.col("mean"))
    return arrays.select(*keys, centred.alias("_c"), F.size("values").alias("n"))


def lag_products(c: np.ndarray, lags: int) -> np.ndarray:
    """Sums of products of values 0 to ``lags`` places apart, from one Fourier transform.

    The series is padded with zeros to more than its length and the lags, so that no product wraps around. The
    time is that of the transform, n log n, whatever the number of lags.
    """
    size = 1 << (len(c) + lags).bit_length()
    spectrum = np.fft.rfft(c, size)
    return np.fft.irfft(spectrum.real**2 + spectrum.imag**2, size)[: lags + 1]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _lag_products(centred: pd.Series, lags: pd.Series) -> pd.Series:
    return pd.Series([lag_products(np.asarray(c, dtype=float), int(k)) for c, k in zip(centred, lags)])


def acf_arrays(panel: DataFrame, lags: int, value: str = VALUE) -> DataFrame:
    """Autocorrelations of lags 0 to ``lags`` as one array ``r`` per series.

    Products are taken around the mean of the whole series and divided by its whole variance.
    """
    centred = _with_centred(panel, value)
    last = F.least(F.lit(lags), F.col("n") - 1)
    # The transform mixes all values, so its products are relative to the plain sum of squares.
    products = centred.select(SERIES, "n", vector_sum(F.transform("_c", lambda c: c * c)).alias("_ss"), _lag_products("_c", last).alias("_p"))
    ratios = F.transform("_p", lambda v: F.try_divide(v, F.col("_ss")))
    return products.select(SERIES, "n", F.transform(ratios, lambda v, k: F.when((k == 0) & v.isNotNull(), F.lit(1.0)).otherwise(v)).alias("r"))


def acf(panel: DataFrame, lags: int = 40, value: str = VALUE) -> DataFrame:
    """Autocorrelation per lag with the half-width of its 95% band (Bartlett)."""
    arrays = acf_arrays(panel, lags, value)
    rows = arrays.select(SERIES, "n", F.posexplode_outer("r").alias("lag", "acf"))
    earlier = Window.partitionBy(SERIES).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    squares = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(earlier), F.lit(0.0))
    band = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(NORMAL_975 * F.sqrt((1 + 2 * squares) / F.col("n")))
    return rows.select(SERIES, "lag", "acf", band.alias("band"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _partial(r: pd.Series) -> pd.Series:
    """Durbin-Levinson recursion on the autocorrelations of each series."""

    def solve(rho: np.ndarray) -> list[float]:
        result, phi = [1.0], np.zeros(0)
        for k in range(1, len(rho)):
            top = rho[k] - phi @ rho[k - 1 : 0 : -1]
            bottom = 1.0 - phi @ rho[1:k]
            last = top / bottom if bottom else np.nan
            phi = np.append(phi - last * phi[::-1], last)
            result.append(float(last))
        return result

    return r.map(lambda values: solve(np.asarray(values, dtype=float)))


def pacf(panel: DataFrame, lags: int = 40, value: str = VALUE) -> DataFrame:
    """Partial autocorrelation per lag with its 95% half-width; only ``lags`` numbers per series reach Python."""
    band = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(NORMAL_975 / F.sqrt("n"))
    rows = acf_arrays(panel, lags, value).select(SERIES, "n", F.posexplode_outer(_partial("r")).alias("lag", "pacf"))
    return rows.select(SERIES, "lag", "pacf", band.alias("band"))


def decompose(panel: DataFrame, period: int = 7, robust: bool = False, value: str = VALUE) -> DataFrame:
    """Classical additive trend, seasonal and residual parts.

    The trend is the centred moving mean (``robust``: median) over one period, null where the frame
    is not full. The seasonal part is the mean (median) of the detrended values of a phase, less the
    mean of all phases.
    """
    if period % 2 == 0:
        raise ValueError("the period must be odd")
    half = period // 2
    frame = by_day().rowsBetween(-half, half)
    middle = (lambda c: F.percentile(c, F.lit(0.5))) if robust else F.avg
    full = F.count(F.col(value)).over(frame) == period
    first_day = F.min(DAY).over(Window.partitionBy(SERIES))
    phase = Window.partitionBy(SERIES, "phase")
    first_of_phase = F.row_number().over(phase.orderBy(DAY)) == 1
    level = F.avg(F.when(F.col("_first"), F.col("_raw"))).over(Window.partitionBy(SERIES))
    return (
        panel.withColumn("phase", F.pmod(F.date_diff(F.col(DAY), first_day), F.lit(period)))
        .withColumn("trend", F.when(full, middle(F.col(value).cast("double")).over(frame)))
        .withColumn("_raw", middle(F.col(value) - F.col("trend")).over(phase))
        .withColumn("_first", first_of_phase)
        .withColumn("seasonal", F.col("_raw") - level)
        .withColumn("residual", F.col(value) - F.col("trend") - F.col("seasonal"))
        .select(SERIES, DAY, value, "phase", "trend", "seasonal", "residual")
    )


def _kpss_columns(lags: int | None) -> dict[str, Column]:
    c, n = F.col("_c"), F.col("n").cast("double")
    start = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("ss"))
    walk = F.aggregate(
        c,
        start,
        lambda a, x: F.struct((a["s"] + x).alias("s"), (a["ss"] + (a["s"] + x) * (a["s"] + x)).alias("ss")),
    )
    columns = {"_walk": walk["ss"], "_g0": _lag_product(c, F.lit(0))}
    if lags is not None:
        columns["lags"] = F.lit(lags)
    else:
        few = F.floor(F.pow(n, F.lit(2.0 / 9.0))).cast("int")
        parts = F.transform(F.sequence(F.lit(1), few), lambda i: _lag_product(c, i) / (n / 2))
        columns["_few"] = parts
    return columns


def kpss(panel: DataFrame, lags: int | None = None, value: str = VALUE, keys: tuple[str, ...] = (SERIES,)) -> DataFrame:
    """Level-stationarity statistic with Bartlett weights; the p-value is interpolated within [0.01, 0.1].

    Without ``lags`` the lag is chosen from the data (Hobijn, Franses and Ooms 1998).
    """
    n = F.col("n").cast("double")
    sums = _with_centred(panel, value, keys).withColumns(_kpss_columns(lags))
    if lags is None:
        s0 = F.col("_g0") / n + vector_sum(F.col("_few"))
        s1 = vector_sum(F.transform(F.col("_few"), lambda g, i: g * (i + 1)))
        ratio = F.try_divide(s1, s0)
        width = F.lit(1.1447) * F.pow(ratio * ratio, F.lit(1.0 / 3.0)) * F.pow(n, F.lit(1.0 / 3.0))
        sums = sums.withColumn("lags", F.floor(F.least(width, (F.col("n") - 1).cast("double"))).cast("int"))
    lag = F.col("lags")
    numbers = F.when(lag > 0, F.sequence(F.lit(1), lag)).otherwise(F.array().cast("array<int>"))
    weighted = F.transform(numbers, lambda i: (1 - i / (lag + 1)) * _lag_product(F.col("_c"), i))
    variance = (F.col("_g0") + 2 * vector_sum(weighted)) / n
    result = sums.withColumn("kpss", F.try_divide(F.col("_walk"), n * n * variance))
    return result.select(*keys, "n", "lags", "kpss", _kpss_p(F.col("kpss")).alias("kpss_p"))


def _kpss_p(stat: Column) -> Column:
    p = F.when(stat <= KPSS_CRITICAL[0], F.lit(KPSS_PROBABILITY[0]))
    for i in range(1, len(KPSS_CRITICAL)):
        low, high = KPSS_CRITICAL[i - 1], KPSS_CRITICAL[i]
        slope = (KPSS_PROBABILITY[i] - KPSS_PROBABILITY[i - 1]) / (high - low)
        p = p.when(stat <= high, F.lit(KPSS_PROBABILITY[i - 1]) + (stat - low) * slope)
    return p.when(stat.isNotNull(), F.lit(KPSS_PROBABILITY[-1]))


def adf_statistic(y: np.ndarray, lag: int | None = None) -> tuple[float, int, int]:
    """Unit-root t statistic with a constant; without ``lag``, the one that minimises AIC on a common sample.

    One orthogonal factorisation gives the residual sums of all nested lag models at once.
    """
    dy = np.diff(y)
    most = min(math.ceil(12.0 * (len(y) / 100.0) ** 0.25), len(y) // 2 - 2)
    if most < 0 or np.ptp(y) == 0:
        return math.nan, 0, 0

    def design(lags: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(lags, len(dy))
        columns = [np.ones(len(rows)), y[rows]] + [dy[rows - k] for k in range(1, lags + 1)]
        return np.column_stack(columns), dy[rows]

    if lag is None:
        x, target = design(most)
        loads = np.linalg.qr(x)[0].T @ target
        residual = np.maximum(target @ target - np.cumsum(loads**2)[1:], 1e-300)
        terms = np.arange(2, most + 3)
        lag = int(np.argmin(len(target) * np.log(residual / len(target)) + 2 * terms))
    x, target = design(min(lag, most))
    lag = min(lag, most)
    beta = np.linalg.lstsq(x, target, rcond=None)[0]
    error = target - x @ beta
    spread = error @ error / (len(target) - x.shape[1]) * np.linalg.pinv(x.T @ x)[1, 1]
    return float(beta[1] / math.sqrt(spread)) if spread > 0 else math.nan, lag, len(target)


def adf_p_value(stat: float) -> float:
    if not stat <= ADF_P_ONE:
        return 1.0 if stat > ADF_P_ONE else math.nan
    if stat < ADF_P_ZERO:
        return 0.0
    terms = ADF_P_SMALL if stat <= ADF_P_SWITCH else ADF_P_LARGE
    point = sum(c * stat**i for i, c in enumerate(terms))
    return 0.5 * math.erfc(-point / math.sqrt(2.0))


@F.pandas_udf(ADF_RESULT)
def _adf(values: pd.Series, lags: pd.Series) -> pd.DataFrame:
    rows = []
    for v, given in zip(values, lags):
        stat, lag, nobs = adf_statistic(np.asarray(v, dtype=float), None if pd.isna(given) else int(given))
        rows.append((stat, adf_p_value(stat), lag, nobs))
    return pd.DataFrame(rows, columns=["adf", "adf_p", "adf_lag", "adf_nobs"])


def adf(panel: DataFrame, value: str = VALUE, keys: tuple[str, ...] = (SERIES,), lag: int | None = None) -> DataFrame:
    """Unit-root test per series: statistic, p-value, lag, critical values at 1, 5 and 10%; ``lag`` fixes the lag."""
    arrays = series_arrays(panel.filter(F.col(value).isNotNull()), value, keys)
    tested = arrays.withColumn("_t", _adf("values", F.lit(lag).cast("int"))).select(*keys, "_t.*")
    n = F.col("adf_nobs").cast("double")
    critical = {
        name: F.lit(c[0]) + c[1] / n + c[2] / (n * n) + c[3] / (n * n * n) for name, c in ADF_CRITICAL.items()
    }
    return tested.withColumns(critical).withColumn("unit_root_rejected", F.col("adf") < F.col("crit_5"))


def stationarity(panel: DataFrame, max_diff: int = 2, value: str = VALUE) -> DataFrame:
    """Both tests on each series and its differences up to ``max_diff``."""
    orders = diffs(panel, range(max_diff + 1), value)
    keys = (SERIES, "order")
    return adf(orders, VALUE, keys).join(kpss(orders, None, VALUE, keys), list(keys))
