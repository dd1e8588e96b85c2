"""Registration of queries with the SQL they are checked against, and shared SQL parts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.sources.fixture import REVIEWS_SQL
from reviewmill.sources.readers import REVIEW_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return add


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six digits, so that the order of summation does not show."""
    return df.withColumns({c: F.round(c, 6) for c in columns})


def with_parts(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


REVIEWS = f"reviews AS ({REVIEWS_SQL.format(lineitem='lineitem', orders='orders', part='part')})"
NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in REVIEW_COLUMNS)
PREPARED = f"""prepared AS (
  SELECT * REPLACE (CAST(customer_id AS BIGINT) AS customer_id) FROM reviews WHERE {NOT_NULL} AND verified_purchase = 'Y')"""
CLEANED = """cleaned AS (
  SELECT * FROM prepared
  WHERE customer_id IN (SELECT customer_id FROM prepared GROUP BY customer_id HAVING count(*) >= 3))"""
SENTIMENT = "CASE WHEN star_rating <= 2 THEN 'negative' WHEN star_rating = 3 THEN 'neutral' ELSE 'positive' END"
LABELLED = f"labelled AS (SELECT *, review_date AS ds, {SENTIMENT} AS sentiment FROM reviews)"
WIDE = """wide AS (
  SELECT category AS series_id, ds,
         nullif(count(*) FILTER (WHERE sentiment = 'negative'), 0) AS negative_count,
         nullif(count(*) FILTER (WHERE sentiment = 'neutral'), 0) AS neutral_count,
         nullif(count(*) FILTER (WHERE sentiment = 'positive'), 0) AS positive_count
  FROM labelled GROUP BY category, ds)"""
PANEL = """spine AS (
  SELECT series_id, unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY))::DATE AS ds
  FROM wide GROUP BY series_id),
panel AS (
  SELECT series_id, ds, negative_count, neutral_count, positive_count,
         positive_count - negative_count AS gap, CAST(year(ds) AS INT) AS "year"
  FROM spine LEFT JOIN wide USING (series_id, ds))"""
DAILY = """daily AS (
  SELECT series_id, ds, CAST(coalesce(n, 0) AS DOUBLE) AS y
  FROM (SELECT series_id, unnest(generate_series(min(ds), max(ds), INTERVAL 1 DAY))::DATE AS ds
        FROM labelled_counts GROUP BY series_id)
  LEFT JOIN labelled_counts USING (series_id, ds))"""
LABELLED_COUNTS = (
    "labelled_counts AS (SELECT category AS series_id, ds, count(*) AS n FROM labelled GROUP BY category, ds)"
)

REVIEWS_ONLY = with_parts(REVIEWS)
PREPARED_PARTS = with_parts(REVIEWS, PREPARED)
CLEANED_PARTS = with_parts(REVIEWS, PREPARED, CLEANED)
LABELLED_PARTS = with_parts(REVIEWS, LABELLED)
WIDE_PARTS = with_parts(REVIEWS, LABELLED, WIDE, PANEL)
DAILY_PARTS = with_parts(REVIEWS, LABELLED, LABELLED_COUNTS, DAILY)


def extended(parts: str, *more: str) -> str:
    """Further named parts after an existing WITH list."""
    return parts.rstrip("\n") + ",\n" + ",\n".join(more) + "\n"


def columns_sql(columns: Sequence[str]) -> str:
    return ", ".join(columns)


def hash_sql(expression: str, seed: int = 42) -> str:
    """The seeded hash of :func:`reviewmill.functions.columns.unit_hash`."""
    return f"(('0x' || substr(md5(concat({expression}, '#{seed}')), 1, 8))::BIGINT / 4294967296::DOUBLE)"


def order_hash_sql(expression: str, seed: int = 42) -> str:
    """The order of :func:`reviewmill.functions.columns.order_hash`."""
    return f"('0x' || substr(md5(concat({expression}, '#{seed}')), 1, 15))::BIGINT"
