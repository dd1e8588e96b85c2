"""Queries over the daily panel: diagnostics, forecasts, backtests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.checks.registry import (
    DAILY_PARTS,
    LABELLED_PARTS,
    WIDE_PARTS,
    extended,
    hash_sql,
    query,
    rounded,
)
from reviewmill.operators import metrics, profiling
from reviewmill.plans import arima, diagnostics, forecast, incremental, panel
from reviewmill.session import cut_lineage, scratch_path
from reviewmill.sources.fixture import reviews, table

CUTOFF = "1995-10-31"
LAGS = 40
LONG_LAGS = 1000
# Of each series, the days before the first fold of a backtest, and of a search.
INITIAL, SEARCH_INITIAL = 0.75, 0.5


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reviews per day, one series per category, no missing days."""
    return panel.count_panel(reviews(spark, sf_dir))


def written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same written out once, for work that reads it many times."""
    return cut_lineage(daily(spark, sf_dir))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean value per event type and day."""
    rows = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("series_id"), F.to_date("ts").alias("ds"))
    return rows.agg(F.avg("value").alias("y"))


# The panel


@query(
    "ts_build_panel",
    WIDE_PARTS
    + f"""SELECT series_id, ds, negative_count, neutral_count, positive_count, gap, "year" FROM panel
    WHERE ds > DATE '{CUTOFF}'""",
)
def ts_build_panel(spark, sf_dir):
    return panel.build_panel(reviews(spark, sf_dir), ["category"], start_after=CUTOFF)


def in_two_loads(spark: SparkSession, sf_dir: str) -> str:
    """Daily counts of a review folder that grows: a load, a second one, and a run that finds nothing new."""
    folder, state = scratch_path(spark, "arrivals"), scratch_path(spark, "counts")
    rows = reviews(spark, sf_dir)
    for load in (rows.filter("review_date < DATE '1998-01-01'"), rows.filter("review_date >= DATE '1998-01-01'"), None):
        if load is not None:
            load.write.mode("append").parquet(folder)
        incremental.update_counts(spark.readStream.schema(rows.schema).parquet(folder), state, ["category"])
    return state


@query(
    "ts_build_panel_incremental",
    WIDE_PARTS
    + f"""SELECT series_id, ds, negative_count, neutral_count, positive_count, gap, "year" FROM panel
    WHERE ds > DATE '{CUTOFF}'""",
)
def ts_build_panel_incremental(spark, sf_dir):
    """The panel of all reviews from counts of two loads."""
    return incremental.counted_panel(spark, in_two_loads(spark, sf_dir), start_after=CUTOFF)


@query(
    "daily_sentiment_counts_incremental",
    LABELLED_PARTS + 'SELECT sentiment, review_date, count(*) AS "count" FROM labelled GROUP BY sentiment, review_date',
)
def daily_sentiment_counts_incremental(spark, sf_dir):
    return incremental.daily_sentiments(spark, in_two_loads(spark, sf_dir))


@query(
    "ts_build_panel_filled",
    WIDE_PARTS
    + """SELECT series_id, ds, coalesce(negative_count, 0) AS negative_count, coalesce(neutral_count, 0) AS neutral_count,
           coalesce(positive_count, 0) AS positive_count,
           coalesce(positive_count, 0) - coalesce(negative_count, 0) AS gap, "year" FROM panel""",
)
def ts_build_panel_filled(spark, sf_dir):
    return panel.build_panel(reviews(spark, sf_dir), ["category"], fill=0)


GAP = """gaps AS (SELECT series_id, ds, CAST(gap AS DOUBLE) AS y FROM panel)"""


@query(
    "ts_transform",
    extended(WIDE_PARTS, GAP)
    + """SELECT series_id, ds, y, CASE WHEN y > 0 THEN round(ln(y), 6) END AS y_ln,
           CASE WHEN y >= 0 THEN round(sqrt(y), 6) END AS y_sqrt FROM gaps""",
)
def ts_transform(spark, sf_dir):
    gaps = panel.build_panel(reviews(spark, sf_dir), ["category"])
    long = gaps.select("series_id", "ds", F.col("gap").cast("double").alias("y"))
    return rounded(panel.transform(long), "y_ln", "y_sqrt")


@query(
    "ts_measure",
    extended(WIDE_PARTS, GAP) + "SELECT series_id, ds, y FROM gaps WHERE y IS NOT NULL",
)
def ts_measure(spark, sf_dir):
    """The gap without the days on which it is unknown."""
    return panel.measure(panel.build_panel(reviews(spark, sf_dir), ["category"]), "gap", missing="drop")


DIFFERENCES = """numbered AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS n FROM daily),
binomials AS (SELECT d."order", k.k, (CASE WHEN k.k % 2 = 0 THEN 1 ELSE -1 END)
      * (factorial(d."order"::INT) / factorial(k.k::INT) / factorial((d."order" - k.k)::INT))::DOUBLE AS weight
  FROM (SELECT unnest(range(1, 21)) AS "order") d, (SELECT unnest(range(0, 21)) AS k) k WHERE k.k <= d."order"),
differenced AS (
  SELECT a.series_id, a.ds, b."order", sum(c.y * b.weight) AS y
  FROM numbered a JOIN binomials b ON a.n > b."order"
  JOIN numbered c ON c.series_id = a.series_id AND c.n = a.n - b.k
  GROUP BY a.series_id, a.ds, b."order")"""


@query(
    "ts_diff_n",
    extended(DAILY_PARTS, DIFFERENCES)
    + 'SELECT series_id, ds, CAST("order" AS INT) AS "order", round(y, 6) AS y FROM differenced',
)
def ts_diff_n(spark, sf_dir):
    return rounded(panel.diffs(daily(spark, sf_dir), range(1, 21)), "y")


@query(
    "win_diff",
    extended(
        DAILY_PARTS,
        """once AS (SELECT series_id, ds, y - lag(y) OVER (PARTITION BY series_id ORDER BY ds) AS y FROM daily)""",
    )
    + """SELECT series_id, ds, round(y, 6) AS y FROM (
      SELECT series_id, ds, y - lag(y) OVER (PARTITION BY series_id ORDER BY ds) AS y FROM once) WHERE y IS NOT NULL""",
)
def win_diff(spark, sf_dir):
    return rounded(panel.diff(daily(spark, sf_dir), 2), "y")


ACF = """centred AS (
  SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS n,
         y - avg(y) OVER (PARTITION BY series_id) AS c FROM daily),
sizes AS (SELECT series_id, count(*) AS n, sum(c * c) AS ss FROM centred GROUP BY series_id),
acf AS (
  SELECT a.series_id, k.lag, sum(a.c * b.c) / any_value(s.ss) AS r, any_value(s.n) AS n
  FROM (SELECT unnest(range(0, {lags} + 1)) AS lag) k
  JOIN centred a ON true
  JOIN centred b ON b.series_id = a.series_id AND b.n = a.n - k.lag
  JOIN sizes s ON s.series_id = a.series_id
  GROUP BY a.series_id, k.lag)"""
ACF_LONG = ACF.format(lags=LONG_LAGS)
ACF = ACF.format(lags=LAGS)
ACF_ROWS = """SELECT series_id, CAST(lag AS INT) AS lag, round(r, 6) AS acf,
           round(CASE WHEN lag = 0 THEN 0 ELSE 1.959963984540054::DOUBLE * sqrt((1 + 2 * coalesce(sum(CASE WHEN lag > 0 THEN r * r END)
             OVER (PARTITION BY series_id ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END, 6) AS band
    FROM acf"""


@query("ts_acf", extended(DAILY_PARTS, ACF) + ACF_ROWS)
def ts_acf(spark, sf_dir):
    return rounded(diagnostics.acf(daily(spark, sf_dir), LAGS), "acf", "band")


@query("ts_acf_long", extended(DAILY_PARTS, ACF_LONG) + ACF_ROWS)
def ts_acf_long(spark, sf_dir):
    """A thousand lags, which shows the seasons of a year and more."""
    return rounded(diagnostics.acf(daily(spark, sf_dir), LONG_LAGS), "acf", "band")


PACF = """rho AS (SELECT series_id, any_value(n) AS n, list(r ORDER BY lag) AS r FROM acf GROUP BY series_id),
steps AS (
  WITH RECURSIVE levinson AS (
    SELECT series_id, n, r, 1 AS k, [r[2]] AS phi FROM rho
    UNION ALL
    SELECT series_id, n, r, k + 1,
           list_append(list_transform(phi, lambda f, j: f - last_phi * phi[k + 1 - j]), last_phi)
    FROM (SELECT *, (r[k + 2] - list_sum(list_transform(phi, lambda f, j: f * r[k + 2 - j])))
                  / (1 - list_sum(list_transform(phi, lambda f, j: f * r[j + 1]))) AS last_phi
          FROM levinson WHERE k < len(r) - 1))
  SELECT series_id, n, k, phi[k] AS last_phi FROM levinson)"""


@query(
    "ts_pacf",
    extended(DAILY_PARTS, ACF, PACF)
    + """SELECT series_id, CAST(k AS INT) AS lag, round(last_phi, 6) AS pacf, round(1.959963984540054::DOUBLE / sqrt(n), 6) AS band FROM steps
    UNION ALL SELECT series_id, 0 AS lag, 1::DOUBLE AS pacf, 0::DOUBLE AS band FROM rho""",
)
def ts_pacf(spark, sf_dir):
    return rounded(diagnostics.pacf(daily(spark, sf_dir), LAGS), "pacf", "band")


def decompose_sql(frame_middle: str, middle: str) -> str:
    return extended(
        DAILY_PARTS,
        f"""trended AS (
      SELECT *, CAST(datediff('day', min(ds) OVER (PARTITION BY series_id), ds) % 7 AS INT) AS phase,
             CASE WHEN count(y) OVER around = 7 THEN {frame_middle} OVER around END AS trend
      FROM daily WINDOW around AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))""",
        f"phases AS (SELECT series_id, phase, {middle} AS raw FROM trended WHERE trend IS NOT NULL GROUP BY series_id, phase)",
        "seasons AS (SELECT series_id, phase, raw - avg(raw) OVER (PARTITION BY series_id) AS seasonal FROM phases)",
    ) + """SELECT series_id, ds, y, phase, round(trend, 6) AS trend, round(seasonal, 6) AS seasonal,
           round(y - trend - seasonal, 6) AS residual FROM trended LEFT JOIN seasons USING (series_id, phase)"""


@query("ts_decompose", decompose_sql("avg(y)", "avg(y - trend)"))
def ts_decompose(spark, sf_dir):
    return rounded(diagnostics.decompose(daily(spark, sf_dir)), "trend", "seasonal", "residual")


@query("ts_decompose_robust", decompose_sql("quantile_cont(y, 0.5)", "quantile_cont(y - trend, 0.5)"))
def ts_decompose_robust(spark, sf_dir):
    return rounded(diagnostics.decompose(daily(spark, sf_dir), robust=True), "trend", "seasonal", "residual")


def kpss_sql(lags: str) -> str:
    return extended(
        DAILY_PARTS,
        """centred AS (
      SELECT series_id, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS i,
             count(*) OVER (PARTITION BY series_id) AS n, y - avg(y) OVER (PARTITION BY series_id) AS c FROM daily)""",
        "walks AS (SELECT *, sum(c) OVER (PARTITION BY series_id ORDER BY i) AS s FROM centred)",
        "sums AS (SELECT series_id, any_value(n)::DOUBLE AS n, sum(s * s) AS ss, sum(c * c) AS g0 FROM walks GROUP BY series_id)",
        """products AS (
      SELECT a.series_id, a.i - b.i AS k, sum(a.c * b.c) AS g
      FROM centred a JOIN centred b ON a.series_id = b.series_id AND a.i - b.i BETWEEN 1 AND 60 GROUP BY 1, 2)""",
        """few AS (
      SELECT series_id, sum(g / (n / 2)) AS f0, sum(k * g / (n / 2)) AS f1
      FROM products JOIN sums USING (series_id) WHERE k <= floor(n ** (2 / 9::DOUBLE)) GROUP BY series_id)""",
        f"chosen AS (SELECT series_id, n, ss, g0, CAST({lags} AS INT) AS lags FROM sums JOIN few USING (series_id))",
        """stats AS (
      SELECT series_id, any_value(n) AS n, lags,
             any_value(ss) / (any_value(n) ** 2 * (any_value(g0) + 2 * coalesce(sum((1 - k / (lags + 1)::DOUBLE) * g), 0)) / any_value(n)) AS kpss
      FROM chosen LEFT JOIN products ON chosen.series_id = products.series_id AND k <= lags
      GROUP BY series_id, lags)""".replace("SELECT series_id, any", "SELECT chosen.series_id AS series_id, any").replace(
            "GROUP BY series_id, lags", "GROUP BY chosen.series_id, lags"
        ),
    ) + """SELECT series_id, CAST(n AS INT) AS n, lags, round(kpss, 6) AS kpss, round(CASE
      WHEN kpss <= 0.347::DOUBLE THEN 0.1::DOUBLE
      WHEN kpss <= 0.463::DOUBLE THEN 0.1::DOUBLE + (kpss - 0.347::DOUBLE) * (0.05::DOUBLE - 0.1::DOUBLE) / (0.463::DOUBLE - 0.347::DOUBLE)
      WHEN kpss <= 0.574::DOUBLE THEN 0.05::DOUBLE + (kpss - 0.463::DOUBLE) * (0.025::DOUBLE - 0.05::DOUBLE) / (0.574::DOUBLE - 0.463::DOUBLE)
      WHEN kpss <= 0.739::DOUBLE THEN 0.025::DOUBLE + (kpss - 0.574::DOUBLE) * (0.01::DOUBLE - 0.025::DOUBLE) / (0.739::DOUBLE - 0.574::DOUBLE)
      ELSE 0.01::DOUBLE END, 6) AS kpss_p FROM stats"""


AUTO_LAGS = "least(floor(1.1447::DOUBLE * ((f1 / (g0 / n + f0)) ** 2) ** (1 / 3::DOUBLE) * n ** (1 / 3::DOUBLE)), n - 1)"


@query("ts_kpss", kpss_sql(AUTO_LAGS))
def ts_kpss(spark, sf_dir):
    return rounded(diagnostics.kpss(daily(spark, sf_dir)), "kpss", "kpss_p")


@query("ts_kpss_fixed_lag", kpss_sql("10"))
def ts_kpss_fixed_lag(spark, sf_dir):
    return rounded(diagnostics.kpss(daily(spark, sf_dir), lags=10), "kpss", "kpss_p")


ADF_ZERO = """changes AS (
  SELECT series_id, lag(y) OVER (PARTITION BY series_id ORDER BY ds) AS x, y - lag(y) OVER (PARTITION BY series_id ORDER BY ds) AS dy FROM daily),
fitted AS (
  SELECT series_id, count(*) AS n, regr_slope(dy, x) AS b, regr_sxx(dy, x) AS sxx, regr_syy(dy, x) AS syy, regr_sxy(dy, x) AS sxy
  FROM changes WHERE x IS NOT NULL GROUP BY series_id),
unit AS (SELECT series_id, n, b / sqrt((syy - b * sxy) / (n - 2) / sxx) AS adf_zero FROM fitted)"""


@query("ts_adf", extended(DAILY_PARTS, ADF_ZERO) + "SELECT series_id, round(adf_zero, 6) AS adf_zero, n AS changes, true AS plausible FROM unit")
def ts_adf(spark, sf_dir):
    """The statistic without lags, and whether the one with the best lag holds what it must (brute force tests compare it)."""
    rows = written(spark, sf_dir)
    chosen, zero = diagnostics.adf(rows), diagnostics.adf(rows, lag=0).select("series_id", F.col("adf").alias("adf_zero"))
    plausible = F.col("adf_p").between(0, 1) & (F.col("adf_lag") >= 0) & (F.col("unit_root_rejected") == (F.col("adf") < F.col("crit_5")))
    found = chosen.join(zero, "series_id")
    changes = (F.col("adf_lag") + F.col("adf_nobs")).cast("bigint").alias("changes")
    return rounded(found.select("series_id", "adf_zero", changes, plausible.alias("plausible")), "adf_zero")


@query("ts_stationarity")
def ts_stationarity(spark, sf_dir):
    """Both tests on the series and its first two differences."""
    return diagnostics.stationarity(daily(spark, sf_dir))


@query("ts_stationarity_train")
def ts_stationarity_train(spark, sf_dir):
    """The same for the gap of positive and negative reviews, before the last 30 days."""
    train = panel.split_last_n(gaps(spark, sf_dir), 30).filter("split = 'train'").drop("split")
    return diagnostics.stationarity(train)


GAPS = "daily AS (SELECT series_id, ds, CAST(coalesce(gap, 0) AS DOUBLE) AS y FROM panel)"


@query("ts_acf_gap", extended(WIDE_PARTS, GAPS, ACF) + ACF_ROWS)
def ts_acf_gap(spark, sf_dir):
    return rounded(diagnostics.acf(gaps(spark, sf_dir), LAGS), "acf", "band")


# Window features


@query(
    "win_lag_features",
    DAILY_PARTS
    + "SELECT series_id, ds, y, "
    + ", ".join(f"lag(y, {k}) OVER (PARTITION BY series_id ORDER BY ds) AS lag_{k}" for k in range(1, 8))
    + " FROM daily",
)
def win_lag_features(spark, sf_dir):
    return panel.lag_columns(daily(spark, sf_dir), 7)


@query(
    "win_sequences",
    DAILY_PARTS
    + """SELECT series_id, ds, array_to_string(list_transform("window", lambda v: CAST(v AS BIGINT)::VARCHAR), ',') AS "window", target
    FROM (SELECT series_id, ds, y AS target, list(y) OVER (PARTITION BY series_id ORDER BY ds
            ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING) AS "window" FROM daily) WHERE len("window") = 8""",
)
def win_sequences(spark, sf_dir):
    rows = panel.sequences(daily(spark, sf_dir), 8, scale=False)
    joined = F.array_join(F.transform("window", lambda v: v.cast("bigint").cast("string")), ",")
    return rows.select("series_id", "ds", joined.alias("window"), "target")


SEQUENCES = """placed AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS place,
              floor((count(*) OVER (PARTITION BY series_id) - 8) * 0.8::DOUBLE) AS train_windows FROM daily),
marked AS (SELECT *, CASE WHEN place <= train_windows + 8 THEN 'train' ELSE 'test' END AS split FROM placed),
bounds AS (SELECT series_id, min(y) AS low, max(y) AS high FROM marked WHERE split = 'train' GROUP BY series_id),
scaled AS (SELECT *, (y - low) / (high - low) AS v FROM marked JOIN bounds USING (series_id))"""


@query(
    "ts_sequences",
    extended(DAILY_PARTS, SEQUENCES)
    + """SELECT t.series_id, t.ds, t.split, round(t.v, 6) AS target, t.low, t.high, CAST(8 - (t.place - w.place) AS INT) AS position,
           round(w.v, 6) AS scaled
    FROM scaled t JOIN scaled w ON w.series_id = t.series_id AND w.place BETWEEN t.place - 8 AND t.place - 1
    WHERE t.place > 8""",
)
def ts_sequences(spark, sf_dir):
    rows = panel.sequences(daily(spark, sf_dir), 8, 0.8)
    long = rows.select("series_id", "ds", "split", "target", "low", "high", F.posexplode("window").alias("position", "scaled"))
    return rounded(long, "target", "scaled")


@query(
    "win_scale_minmax",
    DAILY_PARTS
    + """, split_rows AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) <= 30 THEN 'test' ELSE 'train' END AS split FROM daily),
    bounds AS (SELECT series_id, min(y) AS low, max(y) AS high FROM split_rows WHERE split = 'train' GROUP BY series_id)
    SELECT series_id, ds, y, split, low, high, round((y - low) / (high - low), 6) AS scaled, y AS restored
    FROM split_rows JOIN bounds USING (series_id)""",
)
def win_scale_minmax(spark, sf_dir):
    scaled = panel.scale_minmax(panel.split_last_n(daily(spark, sf_dir), 30))
    back = scaled.withColumn("restored", F.round(panel.unscale_minmax(scaled, "scaled"), 6))
    return rounded(back, "scaled")


@query(
    "win_last_n_split",
    DAILY_PARTS
    + """SELECT series_id, ds, y, CASE WHEN place <= 30 THEN 'test' WHEN place <= 60 THEN 'validation' ELSE 'train' END AS split
    FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS place FROM daily)""",
)
def win_last_n_split(spark, sf_dir):
    return panel.split_last_twice(daily(spark, sf_dir))


@query(
    "union_splits",
    DAILY_PARTS + "SELECT series_id, ds, y FROM daily",
)
def union_splits(spark, sf_dir):
    """Train, validation and test put together again give the panel."""
    parts = panel.split_last_twice(daily(spark, sf_dir))
    pieces = [parts.filter(F.col("split") == name).drop("split") for name in ("train", "validation", "test")]
    return pieces[0].unionByName(pieces[1]).unionByName(pieces[2])


FIRST = f"greatest(1, CAST(floor(count(*) OVER (PARTITION BY series_id) * {INITIAL}::DOUBLE) AS INT))"


@query(
    "win_backtest_folds",
    DAILY_PARTS
    + f"""SELECT series_id, ds, y, CASE WHEN place > first THEN CAST(floor((place - first - 1) / 30) AS INT) END AS fold
    FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS place, {FIRST} AS first FROM daily)""",
)
def win_backtest_folds(spark, sf_dir):
    return panel.backtest_folds(daily(spark, sf_dir), INITIAL)


# Naive forecasts and errors


def naive_sql(season: int = 1) -> str:
    return f"""SELECT series_id, ds, y, predicted FROM (
      SELECT *, lag(y, {season}) OVER (PARTITION BY series_id ORDER BY ds) AS predicted,
             row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS place FROM daily) WHERE place <= 30"""


ERRORS = """round(sqrt(avg((y - predicted) * (y - predicted))), 6) AS rmse, round(avg(abs(y - predicted)), 6) AS mae,
       round(avg(abs(y - predicted) / greatest(abs(y), {floor})), 6) AS mape, count(y - predicted) AS predictions, count(y) AS asked"""
FLOOR_ERRORS = ERRORS.format(floor="2.220446049250313e-16::DOUBLE")
NULL_ERRORS = ERRORS.replace("greatest(abs(y), {floor})", "nullif(abs(y), 0)")


@query("win_naive_forecast", DAILY_PARTS + naive_sql())
def win_naive_forecast(spark, sf_dir):
    return forecast.naive_forecast(daily(spark, sf_dir))


@query("ts_naive", extended(DAILY_PARTS, f"naive AS ({naive_sql()})") + f"SELECT series_id, {NULL_ERRORS} FROM naive GROUP BY series_id")
def ts_naive(spark, sf_dir):
    guesses = forecast.naive_forecast(daily(spark, sf_dir))
    return rounded(metrics.regression_metrics(guesses, "y", "predicted", ["series_id"], zero="null"), "rmse", "mae", "mape")


@query(
    "regression_metrics",
    f"""WITH daily AS (SELECT event_type AS series_id, CAST(ts AS DATE) AS ds, avg("value") AS y FROM events GROUP BY 1, 2),
    naive AS (SELECT series_id, ds, y, lag(y) OVER (PARTITION BY series_id ORDER BY ds) AS predicted FROM daily)
    SELECT series_id, {FLOOR_ERRORS} FROM naive GROUP BY series_id""",
)
def regression_metrics(spark, sf_dir):
    guesses = forecast.naive_forecast(events(spark, sf_dir), n_test=None)
    return rounded(metrics.regression_metrics(guesses, "y", "predicted", ["series_id"]), "rmse", "mae", "mape")


SEASONS = (1, 2, 3, 7, 14)
SEASON_ERRORS = """season_errors AS (
  SELECT series_id, CAST(k.season AS INT) AS season, round(sqrt(avg((a.y - b.y) ** 2)), 6) AS rmse, round(avg(abs(a.y - b.y)), 6) AS mae
  FROM (SELECT unnest([1, 2, 3, 7, 14]) AS season) k
  JOIN (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS place FROM daily) a ON a.place <= 30
  JOIN daily b USING (series_id)
  WHERE b.ds = a.ds - CAST(k.season AS INT) GROUP BY series_id, k.season)"""


@query(
    "best_by_metric",
    extended(DAILY_PARTS, SEASON_ERRORS)
    + """SELECT series_id, mae, rmse, season FROM (
      SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY mae, rmse, season) AS place FROM season_errors) WHERE place = 1""",
)
def best_by_metric(spark, sf_dir):
    """The best look-back of the naive forecast per series."""
    rows = daily(spark, sf_dir)
    tried = metrics.param_grid(rows, season=SEASONS)
    window = panel.by_day("_key")
    keyed = tried.withColumn("_key", F.concat_ws("#", "series_id", "season"))
    for season in SEASONS:
        keyed = keyed.withColumn(f"_b{season}", F.lag("y", season).over(window))
    before = F.coalesce(*[F.when(F.col("season") == s, F.col(f"_b{s}")) for s in SEASONS])
    place = F.row_number().over(panel.Window.partitionBy("_key").orderBy(F.col("ds").desc()))
    guesses = keyed.withColumn("predicted", before).withColumn("_place", place).filter(F.col("_place") <= 30)
    errors = rounded(metrics.regression_metrics(guesses, "y", "predicted", ["series_id", "season"]), "rmse", "mae")
    return metrics.best_by_metric(errors, "mae", ["rmse", "season"], ["series_id"])


@query(
    "param_grid",
    DAILY_PARTS
    + """SELECT series_id, p, d, q FROM (SELECT DISTINCT series_id FROM daily),
      (SELECT unnest([0, 1, 2]) AS p), (SELECT unnest([0, 1, 2]) AS d), (SELECT unnest([0, 1, 2]) AS q)""",
)
def param_grid(spark, sf_dir):
    return arima.order_grid(daily(spark, sf_dir), p=range(3), d=range(3), q=range(3))


BACKTEST = f"""folds AS (
  SELECT series_id, ds, y, CAST(floor((place - first - 1) / 30) AS INT) AS fold, place, first
  FROM (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS place, {FIRST} AS first FROM daily)),
backtested AS (
  SELECT a.series_id, a.ds, a.fold, a.y, b.y AS predicted FROM folds a JOIN folds b
    ON b.series_id = a.series_id AND b.place = a.first + a.fold * 30 WHERE a.place > a.first)"""


@query(
    "ts_backtest",
    extended(DAILY_PARTS, BACKTEST)
    + f"""SELECT fold, {NULL_ERRORS} FROM backtested GROUP BY fold
    UNION ALL SELECT NULL::INT AS fold, {NULL_ERRORS} FROM backtested""",
)
def ts_backtest(spark, sf_dir):
    guesses = forecast.backtest_naive(daily(spark, sf_dir), INITIAL)
    per_fold = metrics.regression_metrics(guesses, "y", "predicted", ["fold"], zero="null")
    pooled = metrics.regression_metrics(guesses, "y", "predicted", zero="null").withColumn("fold", F.lit(None).cast("int"))
    return rounded(per_fold.unionByName(pooled), "rmse", "mae", "mape")


COMPARED = f"""compared AS (
  SELECT 'naive' AS model, * FROM ({naive_sql(1)}) UNION ALL SELECT 'seasonal naive' AS model, * FROM ({naive_sql(7)}))"""


@query("ts_forecast_compare", extended(DAILY_PARTS, COMPARED) + f"SELECT model, {NULL_ERRORS} FROM compared GROUP BY model")
def ts_forecast_compare(spark, sf_dir):
    rows = daily(spark, sf_dir)
    table_ = forecast.compare(
        {"naive": forecast.naive_forecast(rows), "seasonal naive": forecast.naive_forecast(rows, season=7)}
    )
    return rounded(metrics.regression_metrics(table_, "y", "predicted", ["model"], zero="null"), "rmse", "mae", "mape")


PATHS = f"""ends AS (SELECT series_id, max(ds) AS last_day, count(*) AS n FROM daily GROUP BY series_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds) AS place FROM daily),
errors AS (
  SELECT a.series_id, a.place - 8 AS slot, a.y - b.y AS e FROM placed a
  JOIN placed b ON b.series_id = a.series_id AND b.place = a.place - 7),
asked AS (
  SELECT series_id, last_day, n, step, sample FROM ends, (SELECT unnest(range(1, 31)) AS step), (SELECT unnest(range(1, 21)) AS sample)),
draws AS (
  SELECT asked.*, CAST(floor({hash_sql("concat_ws('|', series_id, sample, r.round)")} * (n - 7)) AS BIGINT) AS slot
  FROM asked JOIN (SELECT unnest(range(1, 31)) AS round) r ON r.round <= step AND (step - r.round) % 7 = 0),
drawn AS (
  SELECT draws.series_id, last_day, n, step, sample, sum(e) AS e FROM draws
  JOIN errors ON errors.series_id = draws.series_id AND errors.slot = draws.slot GROUP BY ALL),
paths AS (
  SELECT drawn.series_id, CAST(step AS INT) AS step, CAST(sample AS INT) AS sample, CAST(last_day + CAST(step AS INT) AS DATE) AS ds, y + e AS y
  FROM drawn JOIN placed ON placed.series_id = drawn.series_id AND placed.place = n - 7 + 1 + (step - 1) % 7)"""


@query(
    "sample_quantiles",
    extended(DAILY_PARTS, PATHS)
    + """SELECT series_id, step, round(quantile_cont(y, 0.1), 6) AS q10, round(quantile_cont(y, 0.5), 6) AS q50,
           round(quantile_cont(y, 0.9), 6) AS q90 FROM paths GROUP BY series_id, step""",
)
def sample_quantiles(spark, sf_dir):
    paths = forecast.sample_paths(daily(spark, sf_dir), 30, 20)
    return rounded(profiling.sample_quantiles(paths, "y", ["series_id", "step"]), "q10", "q50", "q90")


@query(
    "ts_quantile_bands",
    extended(DAILY_PARTS, PATHS)
    + """SELECT series_id, ds, step, round(quantile_cont(y, 0.1), 6) AS q10, round(quantile_cont(y, 0.5), 6) AS q50,
           round(quantile_cont(y, 0.9), 6) AS q90 FROM paths GROUP BY series_id, ds, step""",
)
def ts_quantile_bands(spark, sf_dir):
    return rounded(forecast.quantile_bands(daily(spark, sf_dir), 30, 20), "q10", "q50", "q90")


# Models whose figures SQL cannot compute: keys, days, steps, actual values and counts are compared, and of the
# figures, whether they are what they have to be.


def finite(column: str, name: str) -> F.Column:
    value = F.col(column)
    return (value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))).alias(name)


# The values of a forest lie between the least and the greatest value that it has seen.
WITHIN = "bounds AS (SELECT min(y) AS low, max(y) AS high FROM daily)"
LAST_DAYS = "last AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS place FROM daily)"


def within_bounds(rows: DataFrame, forecasts: DataFrame) -> DataFrame:
    bounds = rows.agg(F.min("y").alias("_low"), F.max("y").alias("_high"))
    inside = F.coalesce(F.col("predicted").between(F.col("_low") - 1e-9, F.col("_high") + 1e-9), F.lit(False))
    return forecasts.join(F.broadcast(bounds)).withColumn("inside", inside).drop("_low", "_high", "predicted")


@query("ts_rf_fit", extended(DAILY_PARTS, LAST_DAYS) + "SELECT series_id, ds, y, true AS inside FROM last WHERE place <= 30")
def ts_rf_fit(spark, sf_dir):
    """Fit on all but the last 30 days, forecast those."""
    rows = written(spark, sf_dir)
    return within_bounds(rows, forecast.forecast_rf(rows, 30, trees=20))


@query(
    "ts_recursive_forecast",
    DAILY_PARTS
    + """SELECT series_id, CAST(max(ds) + CAST(h AS INT) AS DATE) AS ds, CAST(h AS INT) AS step, true AS inside
    FROM daily, (SELECT unnest(range(1, 31)) AS h) GROUP BY series_id, h""",
)
def ts_recursive_forecast(spark, sf_dir):
    """Thirty days beyond the end of every series."""
    rows = written(spark, sf_dir)
    model = forecast.fit_rf(rows, trees=5)
    return within_bounds(rows, forecast.recursive_forecast(model, forecast.last_values(rows, forecast.LAGS), 30))


FOLD_COUNTS = """SELECT fold, count(*) AS asked, count(*) AS predictions, true AS plausible FROM folds WHERE place > first GROUP BY fold
    UNION ALL SELECT NULL::INT AS fold, count(*) AS asked, count(*) AS predictions, true AS plausible FROM folds WHERE place > first"""


def plausible_errors(rows: DataFrame, errors: DataFrame) -> DataFrame:
    """Errors of forecasts within the range of the values are not larger than that range."""
    bounds = rows.agg((F.max("y") - F.min("y")).alias("_range"))
    plausible = (F.col("mae") <= F.col("rmse") + 1e-9) & (F.col("rmse") <= F.col("_range") + 1e-9)
    return errors.join(F.broadcast(bounds)).withColumn("plausible", F.coalesce(plausible, F.lit(False))).drop("_range", "rmse", "mae", "mape")


@query("ts_rf_backtest", extended(DAILY_PARTS, BACKTEST) + FOLD_COUNTS)
def ts_rf_backtest(spark, sf_dir):
    rows = written(spark, sf_dir)
    return plausible_errors(rows, forecast.backtest_metrics(forecast.backtest_rf(rows, INITIAL, 30)))


@query("ts_rf_backtest_refit", extended(DAILY_PARTS, BACKTEST) + FOLD_COUNTS)
def ts_rf_backtest_refit(spark, sf_dir):
    """A new forest for each 30-day fold."""
    rows = written(spark, sf_dir)
    return plausible_errors(rows, forecast.backtest_metrics(forecast.backtest_rf(rows, INITIAL, 30, refit=True)))


GRID_SIZE = " CROSS JOIN ".join(
    f"(SELECT unnest({list(values)}) AS {name})" for name, values in forecast.FOREST_GRID.items()
)


@query(
    "ts_rf_grid",
    extended(DAILY_PARTS, BACKTEST.replace(f"{INITIAL}::DOUBLE", f"{SEARCH_INITIAL}::DOUBLE"))
    + f"""SELECT lags, trees, depth, (SELECT count(*) FROM folds WHERE place > first) AS asked,
           (SELECT count(*) FROM folds WHERE place > first) AS predictions, true AS plausible, 1::BIGINT AS winners FROM {GRID_SIZE}""",
)
def ts_rf_grid(spark, sf_dir):
    """All 36 settings on the folds after the first half of each series, and how many are marked as the best one."""
    rows = written(spark, sf_dir)
    errors = forecast.grid_search_rf(rows, SEARCH_INITIAL, 30)
    best = metrics.best_by_metric(errors, "rmse", ["lags", "trees", "depth"]).withColumn("best", F.lit(True))
    marked = errors.join(best.drop("rmse"), ["lags", "trees", "depth"], "left")
    winners = F.count("best").over(panel.Window.partitionBy(F.lit(0)))
    return plausible_errors(rows, marked.withColumn("winners", winners)).drop("best")


@query("ts_rf_tuned")
def ts_rf_tuned(spark, sf_dir):
    """The winner of the search, fitted on all days before the last 30, scored on these."""
    found = forecast.tuned_forest(written(spark, sf_dir), 30, SEARCH_INITIAL)
    return metrics.regression_metrics(found, "y", "predicted", ["lags", "trees", "depth"])


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily difference of positive and negative reviews per category, zero where a side is missing; written out."""
    return cut_lineage(panel.measure(panel.build_panel(reviews(spark, sf_dir), ["category"]), "gap", missing="zero"), "gaps")


@query("ts_rf_tuned_gap")
def ts_rf_tuned_gap(spark, sf_dir):
    """The same for the gap between positive and negative reviews."""
    found = forecast.tuned_forest(gaps(spark, sf_dir), 30, SEARCH_INITIAL)
    return metrics.regression_metrics(found, "y", "predicted", ["lags", "trees", "depth"])


# ARIMA


def forecast_sql(*orders: tuple, step: str = "1") -> str:
    """The last 30 days of each series, for each order."""
    names = (*arima.ORDER, *arima.SEASONAL)
    full = [o if len(o) == 7 else (*o, *arima.NO_SEASON) for o in orders]
    tried = " UNION ALL ".join("SELECT " + ", ".join(f"{v} AS {n}" for v, n in zip(o, names)) for o in full)
    return (
        extended(DAILY_PARTS, LAST_DAYS, f"tried AS ({tried})")
        + f"SELECT series_id, {', '.join(names)}, ds, CAST({step} AS INT) AS step, y, true AS finite FROM last, tried WHERE place <= 30"
    )


def sound(forecasts: DataFrame) -> DataFrame:
    return forecasts.withColumn("finite", finite("predicted", "finite")).drop("predicted")


@query("ts_arima_fit", forecast_sql((1, 0, 0), (2, 1, 1), step="31 - place"))
def ts_arima_fit(spark, sf_dir):
    return sound(arima.arima_forecast(daily(spark, sf_dir), [(1, 0, 0), (2, 1, 1)], 30))


@query("ts_arima_rolling", forecast_sql((2, 1, 1)))
def ts_arima_rolling(spark, sf_dir):
    return sound(arima.arima_rolling(daily(spark, sf_dir), [(2, 1, 1)], 30))


SIMPLE_ORDERS = [(1, 0, 0), (0, 1, 0), (1, 1, 0)]
# Orders whose least-squares fit is one running regression: predictions use the fit up to the day before.
SIMPLE = """steps AS (
  SELECT *, y - lag(y) OVER (PARTITION BY series_id ORDER BY ds) AS w, lag(y) OVER (PARTITION BY series_id ORDER BY ds) AS y1,
         row_number() OVER (PARTITION BY series_id ORDER BY ds DESC) AS place FROM daily),
changes AS (SELECT *, lag(w) OVER (PARTITION BY series_id ORDER BY ds) AS w1 FROM steps),
fits AS (
  SELECT *, regr_slope(y, y1) OVER upto AS slope, regr_intercept(y, y1) OVER upto AS intercept,
         sum(w * w1) OVER upto / sum(w1 * w1) FILTER (WHERE w IS NOT NULL) OVER upto AS change_slope
  FROM changes WINDOW upto AS (PARTITION BY series_id ORDER BY ds ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rolled AS (
  SELECT series_id, 1 AS p, 0 AS d, 0 AS q, ds, y, intercept + slope * y1 AS predicted FROM fits WHERE place <= 30
  UNION ALL SELECT series_id, 0 AS p, 1 AS d, 0 AS q, ds, y, y1 AS predicted FROM fits WHERE place <= 30
  UNION ALL SELECT series_id, 1 AS p, 1 AS d, 0 AS q, ds, y, y1 + change_slope * w1 AS predicted FROM fits WHERE place <= 30)"""


@query(
    "ts_arima_rolling_simple",
    extended(DAILY_PARTS, SIMPLE) + "SELECT series_id, p, d, q, ds, y, round(predicted, 6) AS predicted FROM rolled",
)
def ts_arima_rolling_simple(spark, sf_dir):
    """Orders with a closed form, refitted at each of the last 30 days."""
    rows = arima.arima_rolling(daily(spark, sf_dir), SIMPLE_ORDERS, 30)
    return rounded(rows.select("series_id", "p", "d", "q", "ds", "y", "predicted"), "predicted")


@query(
    "ts_arima_search_simple",
    extended(DAILY_PARTS, SIMPLE)
    + """SELECT series_id, p, d, q, rmse, mae, predictions FROM (
      SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY exact) AS place FROM (
        SELECT series_id, p, d, q, sqrt(avg((y - predicted) ** 2)) AS exact, round(sqrt(avg((y - predicted) ** 2)), 6) AS rmse,
               round(avg(abs(y - predicted)), 6) AS mae, count(*) AS predictions FROM rolled GROUP BY series_id, p, d, q)) WHERE place = 1""",
)
def ts_arima_search_simple(spark, sf_dir):
    best = arima.arima_search(daily(spark, sf_dir), SIMPLE_ORDERS, 30)
    return rounded(best.select("series_id", "p", "d", "q", "rmse", "mae", "predictions"), "rmse", "mae")


@query(
    "ts_arima_fit_simple",
    extended(
        DAILY_PARTS,
        "numbered AS (SELECT *, lag(y) OVER (PARTITION BY series_id ORDER BY ds) AS y1 FROM daily)",
        """ends AS (SELECT series_id, regr_slope(y, y1) AS slope, regr_intercept(y, y1) AS intercept,
                max(ds) AS last_day, arg_max(y, ds) AS last_y FROM numbered GROUP BY series_id)""",
    )
    + """SELECT series_id, CAST(last_day + CAST(h AS INT) AS DATE) AS ds, CAST(h AS INT) AS step,
           round(slope ** h * last_y + intercept * (1 - slope ** h) / (1 - slope), 6) AS predicted
    FROM ends, (SELECT unnest(range(1, 31)) AS h)""",
)
def ts_arima_fit_simple(spark, sf_dir):
    """Thirty days beyond the end by a first-order autoregression."""
    rows = arima.arima_forecast(daily(spark, sf_dir), [(1, 0, 0)], 30, holdout=False)
    return rounded(rows.select("series_id", "ds", "step", "predicted"), "predicted")


OWN_ORDERS = SIMPLE.replace("place <= 30", "place <= 60").replace("SELECT series_id, 1 AS p", "SELECT place, series_id, 1 AS p").replace(
    "SELECT series_id, 0 AS p", "SELECT place, series_id, 0 AS p"
)
# The fits of the last 60 days: the first 30 of them choose the order of the series.
CHOSEN = """chosen AS (
  SELECT series_id, p, d, q FROM (
    SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY exact, p, d, q) AS best FROM (
      SELECT series_id, p, d, q, sqrt(avg((y - predicted) ** 2)) AS exact FROM rolled WHERE place > 30 GROUP BY series_id, p, d, q))
  WHERE best = 1)"""


@query(
    "ts_arima_auto_rolling_simple",
    extended(DAILY_PARTS, OWN_ORDERS, CHOSEN)
    + """SELECT series_id, p, d, q, ds, y, round(predicted, 6) AS predicted
    FROM rolled JOIN chosen USING (series_id, p, d, q) WHERE place <= 30""",
)
def ts_arima_auto_rolling_simple(spark, sf_dir):
    """Each series rolls with the order found for it, among orders with a closed form."""
    rows = arima.arima_auto_rolling(written(spark, sf_dir), SIMPLE_ORDERS, 30, 30, rolling=True)
    return rounded(rows.select("series_id", "p", "d", "q", "ds", "y", "predicted"), "predicted")


@query("ts_arima_auto_rolling")
def ts_arima_auto_rolling(spark, sf_dir):
    """Wide search before the test, then refits at each of the last 30 days with the order of the series."""
    orders = arima.search_orders(range(11), range(3), range(6), max_order=10)
    return arima.arima_auto_rolling(written(spark, sf_dir), orders, 30, 30)


@query("ts_sarima_auto_rolling")
def ts_sarima_auto_rolling(spark, sf_dir):
    """The same with weekly terms."""
    seasonal = [(a, b, c, 7) for a in range(3) for b in range(2) for c in range(3)]
    orders = arima.search_orders(range(6), range(2), range(6), max_order=5, seasonal=seasonal)
    return arima.arima_auto_rolling(written(spark, sf_dir), orders, 30, 30)


SEARCHED = extended(DAILY_PARTS, LAST_DAYS) + "SELECT series_id, count(*) AS predictions, true AS plausible FROM last WHERE place <= 30 GROUP BY series_id"


def no_worse(best: DataFrame, simple: DataFrame) -> DataFrame:
    """The winner of a search is not worse than that of a part of the orders."""
    other = simple.select("series_id", F.col("rmse").alias("_simple"))
    plausible = (F.col("rmse") <= F.col("_simple") + 1e-9) & (F.col("mae") <= F.col("rmse") + 1e-9)
    return best.join(other, "series_id").select("series_id", "predictions", plausible.alias("plausible"))


@query("ts_arima_order_search", SEARCHED)
def ts_arima_order_search(spark, sf_dir):
    """All orders up to (2, 2, 2): the best is not worse than the best of three of them."""
    rows = written(spark, sf_dir)
    return no_worse(arima.arima_search(rows), arima.arima_search(rows, SIMPLE_ORDERS))


@query("ts_arima_auto", SEARCHED)
def ts_arima_auto(spark, sf_dir):
    """Wide search with one fit per order, scored on the last 30 days."""
    rows = written(spark, sf_dir)
    orders = arima.search_orders(range(11), range(3), range(6), max_order=10)
    return no_worse(arima.arima_search(rows, orders, rolling=False), arima.arima_search(rows, SIMPLE_ORDERS, rolling=False))


@query("ts_sarima_auto")
def ts_sarima_auto(spark, sf_dir):
    seasonal = [(a, b, c, 7) for a in range(3) for b in range(2) for c in range(3)]
    orders = arima.search_orders(range(6), range(2), range(6), max_order=5, seasonal=seasonal)
    return arima.arima_search(daily(spark, sf_dir), orders, rolling=False)


@query("ts_sarima_rolling", forecast_sql((*arima.CHOSEN_ORDER, *arima.CHOSEN_SEASONAL)))
def ts_sarima_rolling(spark, sf_dir):
    return sound(arima.arima_rolling(daily(spark, sf_dir), [arima.CHOSEN_ORDER], 30, seasonal=arima.CHOSEN_SEASONAL))


@query("ts_sarima_backtest")
def ts_sarima_backtest(spark, sf_dir):
    rows = arima.arima_backtest(daily(spark, sf_dir), arima.CHOSEN_ORDER, INITIAL, 30, arima.CHOSEN_SEASONAL)
    return metrics.regression_metrics(rows, "y", "predicted", ["series_id"])


@query(
    "ts_long_horizon",
    DAILY_PARTS
    + f"""SELECT series_id, CAST(max(ds) + CAST(h AS INT) AS DATE) AS ds, CAST(h AS INT) AS step, true AS finite
    FROM daily, (SELECT unnest(range(1, {arima.LONG_HORIZON + 1})) AS h) GROUP BY series_id, h""",
)
def ts_long_horizon(spark, sf_dir):
    rows = arima.arima_forecast(
        daily(spark, sf_dir), [arima.CHOSEN_ORDER], arima.LONG_HORIZON, seasonal=arima.CHOSEN_SEASONAL, holdout=False
    )
    return sound(rows).select("series_id", "ds", "step", "finite")


@query("ts_arima_rolling_gap", extended(WIDE_PARTS, GAPS, SIMPLE) + "SELECT series_id, p, d, q, ds, y, round(predicted, 6) AS predicted FROM rolled")
def ts_arima_rolling_gap(spark, sf_dir):
    """Orders with a closed form on the gap of positive and negative reviews."""
    rows = arima.arima_rolling(gaps(spark, sf_dir), SIMPLE_ORDERS, 30)
    return rounded(rows.select("series_id", "p", "d", "q", "ds", "y", "predicted"), "predicted")


@query("ts_forecast_compare_models")
def ts_forecast_compare_models(spark, sf_dir):
    rows = written(spark, sf_dir)
    compared = forecast.compare(
        {
            "naive": forecast.naive_forecast(rows),
            "arima": arima.arima_rolling(rows, [(2, 1, 1)]),
            "sarima": arima.arima_rolling(rows, [arima.CHOSEN_ORDER], seasonal=arima.CHOSEN_SEASONAL),
            "forest": forecast.forecast_rf(rows, trees=20),
        }
    )
    return metrics.regression_metrics(compared, "y", "predicted", ["model"])
