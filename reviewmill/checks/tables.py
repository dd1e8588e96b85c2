"""Queries over the review table: sources and sinks, filters, joins, aggregates, windows, samples, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.checks.registry import (
    CLEANED_PARTS,
    LABELLED_PARTS,
    PREPARED_PARTS,
    REVIEWS_ONLY,
    SENTIMENT,
    WIDE_PARTS,
    columns_sql,
    extended,
    hash_sql,
    order_hash_sql,
    query,
    rounded,
)
from reviewmill.functions import columns as fn
from reviewmill.operators import cleaning, metrics, numbering, profiling, sampling, sketches, splitting
from reviewmill.operators.recommend import fit_item_index
from reviewmill.plans import panel
from reviewmill.session import cut_lineage, scratch_path
from reviewmill.sources import history, readers, writers
from reviewmill.sources.fixture import reviews, table

COLUMNS = readers.REVIEW_COLUMNS
ALL = columns_sql(COLUMNS)
ALL_TEXT = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in COLUMNS)


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns as text, with damaged ratings and dates where the title is missing."""
    text = as_text(reviews(spark, sf_dir))
    damaged = F.col("product_title").isNull()
    return text.withColumns(
        {
            "star_rating": F.when(damaged, F.lit("x")).otherwise(F.col("star_rating")),
            "review_date": F.when(damaged, F.lit("unknown")).otherwise(F.col("review_date")),
        }
    )


RAW_SQL = extended(
    REVIEWS_ONLY,
    f"""raw AS (SELECT * REPLACE (
      CASE WHEN product_title IS NULL THEN 'x' ELSE star_rating END AS star_rating,
      CASE WHEN product_title IS NULL THEN 'unknown' ELSE review_date END AS review_date)
    FROM (SELECT {ALL_TEXT} FROM reviews))""",
)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.label_reviews(reviews(spark, sf_dir))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_reviews(reviews(spark, sf_dir))


def refined(spark: SparkSession, sf_dir: str, columns: Sequence[str] = COLUMNS) -> DataFrame:
    """The cleaned reviews written out once, for operators that read them several times; only ``columns`` of them."""
    return cut_lineage(cleaned(spark, sf_dir).select(*columns), "refined")


# Sources and sinks


@query("src_reviews_tsv", REVIEWS_ONLY + f"SELECT {ALL_TEXT} FROM reviews")
def src_reviews_tsv(spark, sf_dir):
    path = scratch_path(spark, "reviews-tsv")
    writers.write_tsv(reviews(spark, sf_dir), path)
    return readers.read_reviews(spark, path)


@query("src_category_from_file", REVIEWS_ONLY + f"SELECT {ALL_TEXT} FROM reviews")
def src_category_from_file(spark, sf_dir):
    """Files named by category; some carry lines with too many fields, which must not come back."""
    path = scratch_path(spark, "reviews-by-file")
    stored = [c for c in COLUMNS if c != "category"]
    rows = as_text(reviews(spark, sf_dir))
    spoiled = rows.filter(F.col("product_title").isNull()).withColumn(
        "product_category", F.concat_ws("\t", "product_category", "review_id", "product_id")
    )
    name = F.concat(F.lit("reviews_us_"), F.initcap("category"), F.lit("_v1_00.tsv")).alias("file")
    writers.write_named_tsv(rows.unionByName(spoiled).select(*stored, name), path, "file")
    return readers.read_reviews(spark, path, category_from_file=True)


@query("src_rejected_lines", REVIEWS_ONLY + "SELECT review_id, count(*) AS lines FROM reviews WHERE product_title IS NULL GROUP BY review_id")
def src_rejected_lines(spark, sf_dir):
    """The lines the reader skips, kept for inspection."""
    path = scratch_path(spark, "reviews-rejected")
    rows = as_text(reviews(spark, sf_dir))
    spoiled = rows.filter(F.col("product_title").isNull()).withColumn(
        "product_category", F.concat_ws("\t", "product_category", "review_id", "product_id")
    )
    rows.unionByName(spoiled).write.csv(path, sep="\t", header=True, quote="", escape="")
    rejected = readers.read_rejected(spark, path, COLUMNS)
    review_id = F.element_at(F.split("line", "\t"), COLUMNS.index("review_id") + 1)
    return rejected.groupBy(review_id.alias("review_id")).agg(F.count("*").alias("lines"))


@query("src_parquet", "SELECT * FROM lineitem")
def src_parquet(spark, sf_dir):
    return readers.read_parquet(spark, f"{sf_dir}/lineitem.parquet")


@query("src_csv_inferred", REVIEWS_ONLY + "SELECT category, CAST(count(*) AS INT) AS \"count\" FROM reviews GROUP BY category")
def src_csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "counts-csv")
    writers.write_single_csv(profiling.rows_per_key(reviews(spark, sf_dir)), path)
    return readers.read_csv_inferred(spark, path)


@query("sink_parquet", CLEANED_PARTS + f"SELECT {ALL} FROM cleaned")
def sink_parquet(spark, sf_dir):
    path = scratch_path(spark, "refined")
    writers.write_parquet(cleaned(spark, sf_dir), path, partition_by=["category"])
    return readers.read_parquet(spark, path).select(*COLUMNS)


@query(
    "sink_csv_single",
    PREPARED_PARTS
    + """SELECT * FROM (SELECT unnest(['Total Records', 'Verified Records']) AS metric,
           unnest([CAST((SELECT count(*) FROM reviews) AS INT), CAST((SELECT count(*) FROM prepared) AS INT)]) AS "value")""",
)
def sink_csv_single(spark, sf_dir):
    path = scratch_path(spark, "metrics-csv")
    funnel = cleaning.cleaning_funnel(reviews(spark, sf_dir)).filter(F.col("step").isin(1, 3))
    writers.write_single_csv(funnel.select("metric", "value"), path)
    return readers.read_csv_inferred(spark, path)


@query(
    "sink_split_by_label",
    LABELLED_PARTS + "SELECT sentiment, review_date, count(*) AS \"count\" FROM labelled GROUP BY sentiment, review_date",
)
def sink_split_by_label(spark, sf_dir):
    path = scratch_path(spark, "by-sentiment")
    writers.write_split_by_label(profiling.daily_sentiment_counts(labelled(spark, sf_dir)), path)
    return readers.read_parquet(spark, path)


@query(
    "metric_table",
    REVIEWS_ONLY
    + """SELECT unnest(['rows', 'lowest rating', 'highest rating']) AS metric,
           unnest([CAST(count(*) AS DOUBLE), CAST(min(star_rating) AS DOUBLE), CAST(max(star_rating) AS DOUBLE)]) AS "value"
    FROM reviews""",
)
def metric_table(spark, sf_dir):
    return metrics.metric_table(
        reviews(spark, sf_dir),
        {"rows": F.count("*"), "lowest rating": F.min("star_rating"), "highest rating": F.max("star_rating")},
    )


# Projections and filters


@query("project_columns", REVIEWS_ONLY + f"SELECT {ALL} FROM reviews")
def project_columns(spark, sf_dir):
    wide = reviews(spark, sf_dir).withColumn("unused", F.lit(1))
    return cleaning.project_columns(wide)


@query("drop_columns", REVIEWS_ONLY + "SELECT * EXCLUDE (product_title, verified_purchase) FROM reviews")
def drop_columns(spark, sf_dir):
    return cleaning.drop_columns(reviews(spark, sf_dir), ["product_title", "verified_purchase"])


@query(
    "rename_prefix",
    LABELLED_PARTS
    + """SELECT review_date, count(*) AS negative_count FROM labelled WHERE sentiment = 'negative' GROUP BY review_date""",
)
def rename_prefix(spark, sf_dir):
    negative = labelled(spark, sf_dir).filter(F.col("sentiment") == "negative")
    daily = negative.groupBy("review_date").agg(F.count("*").alias("count"))
    return cleaning.rename_prefix(daily, "negative_", keep=["review_date"])


@query("drop_nulls", REVIEWS_ONLY + "SELECT * FROM reviews WHERE product_title IS NOT NULL")
def drop_nulls(spark, sf_dir):
    return cleaning.drop_nulls(reviews(spark, sf_dir), ["product_title", "review_id"])


@query("filter_verified", REVIEWS_ONLY + "SELECT * FROM reviews WHERE verified_purchase = 'Y'")
def filter_verified(spark, sf_dir):
    return cleaning.filter_verified(reviews(spark, sf_dir))


@query(
    "filter_min_activity",
    PREPARED_PARTS
    + "SELECT * FROM prepared WHERE customer_id IN (SELECT customer_id FROM prepared GROUP BY 1 HAVING count(*) >= 25)",
)
def filter_min_activity(spark, sf_dir):
    return cleaning.min_activity(cleaning.prepare_reviews(reviews(spark, sf_dir)), "customer_id", 25)


@query(
    "cast_types",
    RAW_SQL
    + """SELECT * REPLACE (TRY_CAST(star_rating AS FLOAT) AS star_rating, TRY_CAST(customer_id AS BIGINT) AS customer_id)
    FROM raw""",
)
def cast_types(spark, sf_dir):
    return cleaning.cast_types(raw_reviews(spark, sf_dir))


@query("clean_reviews", CLEANED_PARTS + f"SELECT {ALL} FROM cleaned")
def clean_reviews(spark, sf_dir):
    return cleaned(spark, sf_dir)


@query("sentiment_label", REVIEWS_ONLY + f"SELECT review_id, star_rating, {SENTIMENT} AS sentiment FROM reviews")
def sentiment_label(spark, sf_dir):
    label = fn.sentiment_label(F.col("star_rating")).alias("sentiment")
    return reviews(spark, sf_dir).select("review_id", "star_rating", label)


@query(
    "label_encode",
    LABELLED_PARTS
    + """SELECT review_id, CASE sentiment WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 ELSE 2 END AS label,
           sentiment AS decoded FROM labelled""",
)
def label_encode(spark, sf_dir):
    label = fn.encode(F.col("sentiment"), fn.LABEL_TO_ID)
    coded = labelled(spark, sf_dir).select("review_id", label.alias("label"))
    return coded.withColumn("decoded", fn.decode(F.col("label"), fn.LABEL_TO_ID))


@query(
    "filter_in_ids",
    REVIEWS_ONLY + "SELECT * FROM reviews WHERE customer_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def filter_in_ids(spark, sf_dir):
    debtors = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("customer_id"))
    return cleaning.filter_in_ids(reviews(spark, sf_dir), debtors, "customer_id")


MASKED = """masked AS (
  SELECT *, CAST(floor(number_of_products * 0.3::DOUBLE) AS INT) AS number_of_products_to_mask
  FROM (SELECT *, count(*) OVER (PARTITION BY customer_id) AS number_of_products,
               CAST(rank() OVER (PARTITION BY customer_id ORDER BY product_id DESC) AS INT) AS product_rank
        FROM cleaned))"""
SPLIT = """split_rows AS (
  SELECT *, CASE WHEN product_rank <= number_of_products_to_mask THEN 'test' ELSE 'train' END AS split FROM masked)"""


@query(
    "user_history",
    extended(CLEANED_PARTS, MASKED, SPLIT)
    + """SELECT customer_id, split, product_id, product_title, product_category, star_rating FROM split_rows
    WHERE customer_id IN (SELECT c_custkey FROM customer)""",
)
def user_history(spark, sf_dir):
    splits = splitting.split_mask(refined(spark, sf_dir), fraction=splitting.MASK_FRACTION)
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))
    return cleaning.user_history(splits, users)


@query(
    "user_history_lookup",
    extended(CLEANED_PARTS, MASKED, SPLIT)
    + """SELECT customer_id, split, product_id, product_title, product_category, star_rating FROM split_rows
    WHERE customer_id IN (1, 7, 100)""",
)
def user_history_lookup(spark, sf_dir):
    """The history of a few customers from a stored table of all reviews, of which only their buckets are read."""
    splits = splitting.split_mask(refined(spark, sf_dir), fraction=splitting.MASK_FRACTION)
    stored = scratch_path(spark, "history")
    name = f"history_{stored.rsplit('-', 1)[1]}"
    history.write_history(splits.select("customer_id", "split", *cleaning.HISTORY_COLUMNS), name, stored, buckets=16)
    return history.look_up(spark, name, [1, 7, 100])


@query("filter_date_after", REVIEWS_ONLY + "SELECT * FROM reviews WHERE review_date > DATE '1995-10-31'")
def filter_date_after(spark, sf_dir):
    return reviews(spark, sf_dir).filter(F.col("review_date") > F.lit("1995-10-31").cast("date"))


@query(
    "filter_by_rank",
    extended(CLEANED_PARTS, MASKED) + f"SELECT {ALL}, product_rank FROM masked WHERE product_rank <= 3",
)
def filter_by_rank(spark, sf_dir):
    ranked = numbering.ranked(refined(spark, sf_dir), ["customer_id"], "product_id")
    return ranked.filter(F.col("product_rank") <= 3).drop("number_of_products")


@query("truncate_text", "SELECT doc_id, substr(text, 1, 450) AS head FROM documents")
def truncate_text(spark, sf_dir):
    """The first 450 characters are what the operator is for."""
    return table(spark, sf_dir, "documents").select("doc_id", fn.truncate_text(F.col("text")).alias("head"))


@query("text_length", "SELECT doc_id, CAST(length(text) AS INT) AS text_length FROM documents")
def text_length(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("text_length"))


@query(
    "derive_gap_year",
    WIDE_PARTS
    + """SELECT series_id, ds, negative_count, neutral_count, positive_count,
           positive_count - negative_count AS gap, CAST(year(ds) AS INT) AS "year" FROM wide""",
)
def derive_gap_year(spark, sf_dir):
    return panel.derive_gap_year(panel.wide_counts(reviews(spark, sf_dir), ["category"]))


SCHEMA_TYPES = {
    "customer_id": "int",
    "star_rating": "float",
    "review_date": "date",
}


@query(
    "schema_report",
    REVIEWS_ONLY
    + " UNION ALL ".join(
        f"SELECT {i} AS \"position\", '{c}' AS column_name, '{SCHEMA_TYPES.get(c, 'string')}' AS type, count({c}) AS non_null FROM reviews"
        for i, c in enumerate(COLUMNS)
    ),
)
def schema_report(spark, sf_dir):
    return cleaning.schema_report(reviews(spark, sf_dir))


@query("parse_date", RAW_SQL + "SELECT review_id, TRY_CAST(review_date AS DATE) AS ds FROM raw")
def parse_date(spark, sf_dir):
    return raw_reviews(spark, sf_dir).select("review_id", fn.to_day(F.col("review_date")).alias("ds"))


# Joins


@query(
    "join_inner_key",
    PREPARED_PARTS
    + f"""SELECT {ALL}, key_rows FROM prepared
    JOIN (SELECT customer_id, count(*) AS key_rows FROM prepared GROUP BY customer_id HAVING count(*) >= 3) USING (customer_id)""",
)
def join_inner_key(spark, sf_dir):
    return cleaning.join_qualifying(cleaning.prepare_reviews(reviews(spark, sf_dir)), "customer_id")


@query(
    "join_semi_ids",
    REVIEWS_ONLY
    + f"""SELECT * FROM reviews WHERE customer_id IN
      (SELECT DISTINCT customer_id FROM reviews WHERE {hash_sql('customer_id')} < 0.1::DOUBLE)""",
)
def join_semi_ids(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    ids = rows.select("customer_id").distinct().filter(fn.unit_hash(F.col("customer_id"), sampling.SEED) < 0.1)
    return cleaning.filter_in_ids(rows, ids, "customer_id")


WIDE_BY_DATE = """SELECT review_date,
       nullif(count(*) FILTER (WHERE sentiment = 'negative'), 0) AS negative_count,
       nullif(count(*) FILTER (WHERE sentiment = 'neutral'), 0) AS neutral_count,
       nullif(count(*) FILTER (WHERE sentiment = 'positive'), 0) AS positive_count
FROM labelled GROUP BY review_date"""


@query("join_full_outer_dates", LABELLED_PARTS + WIDE_BY_DATE)
def join_full_outer_dates(spark, sf_dir):
    return panel.outer_join_series(profiling.daily_sentiment_counts(labelled(spark, sf_dir)))


@query("pivot_series", LABELLED_PARTS + WIDE_BY_DATE)
def pivot_series(spark, sf_dir):
    return panel.pivot_series(profiling.daily_sentiment_counts(labelled(spark, sf_dir)))


@query(
    "join_date_spine",
    WIDE_PARTS + "SELECT series_id, ds, negative_count, neutral_count, positive_count FROM panel",
)
def join_date_spine(spark, sf_dir):
    return panel.fill_days(panel.wide_counts(reviews(spark, sf_dir), ["category"]))


# Aggregates


@query("count_rows", REVIEWS_ONLY + 'SELECT count(*) AS "rows" FROM reviews')
def count_rows(spark, sf_dir):
    return profiling.count_rows(reviews(spark, sf_dir))


FUNNEL = """funnel AS (
  SELECT unnest([1, 2, 3, 4]) AS step,
         unnest(['Total Records', 'Filtered Records (No Nulls)', 'Verified Records',
                 'Customers with three or more reviews count']) AS metric,
         unnest([(SELECT count(*) FROM reviews), (SELECT count(*) FROM reviews WHERE product_title IS NOT NULL),
                 (SELECT count(*) FROM prepared), (SELECT count(*) FROM cleaned)]) AS "value")"""


@query("cleaning_funnel", extended(CLEANED_PARTS, FUNNEL) + "SELECT * FROM funnel")
def cleaning_funnel(spark, sf_dir):
    return cleaning.cleaning_funnel(reviews(spark, sf_dir))


@query(
    "funnel_removed",
    extended(CLEANED_PARTS, FUNNEL)
    + """SELECT * FROM (SELECT step, metric, lag("value") OVER (ORDER BY step) - "value" AS removed FROM funnel)
    WHERE removed IS NOT NULL""",
)
def funnel_removed(spark, sf_dir):
    return cleaning.funnel_removed(cleaning.cleaning_funnel(reviews(spark, sf_dir)))


@query(
    "rows_per_category",
    CLEANED_PARTS
    + """SELECT 'before' AS stage, category, count(*) AS "count" FROM reviews GROUP BY category
    UNION ALL SELECT 'after' AS stage, category, count(*) AS "count" FROM cleaned GROUP BY category""",
)
def rows_per_category(spark, sf_dir):
    before = profiling.rows_per_key(reviews(spark, sf_dir)).withColumn("stage", F.lit("before"))
    after = profiling.rows_per_key(cleaned(spark, sf_dir)).withColumn("stage", F.lit("after"))
    return before.unionByName(after)


@query(
    "avg_rating_per_category",
    CLEANED_PARTS + "SELECT category, round(avg(star_rating), 6) AS avg_rating FROM cleaned GROUP BY category",
)
def avg_rating_per_category(spark, sf_dir):
    return rounded(profiling.average_by(cleaned(spark, sf_dir), "star_rating", ["category"]), "avg_rating")


@query("avg_rating_global", CLEANED_PARTS + "SELECT round(avg(star_rating), 6) AS avg_rating FROM cleaned")
def avg_rating_global(spark, sf_dir):
    return rounded(profiling.average_by(cleaned(spark, sf_dir), "star_rating"), "avg_rating")


@query(
    "distinct_counts",
    CLEANED_PARTS + "SELECT count(DISTINCT product_id) AS products, count(DISTINCT customer_id) AS customers FROM cleaned",
)
def distinct_counts(spark, sf_dir):
    return profiling.distinct_counts(cleaned(spark, sf_dir))


def sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sketches of the cleaned reviews, written in two loads, of which one is repeated."""
    rows, path = refined(spark, sf_dir), scratch_path(spark, "sketches")
    rows = rows.withColumn("title_length", F.length("product_title"))
    late = F.col("review_date") >= F.lit("1998-01-01").cast("date")
    for load, part in (("early", rows.filter(~late)), ("late", rows.filter(late)), ("late", rows.filter(late))):
        daily = sketches.sketch(part, ["review_date"], distinct=["product_id", "customer_id"], numbers=["title_length"])
        sketches.write_load(daily, path, load)
    return sketches.read_loads(spark, path)


@query(
    "distinct_counts_merged",
    CLEANED_PARTS
    + """SELECT CAST(year(review_date) AS INT) AS "year", count(*) AS "rows", count(DISTINCT product_id) AS products,
           count(DISTINCT customer_id) AS customers, true AS within FROM cleaned GROUP BY 1""",
)
def distinct_counts_merged(spark, sf_dir):
    """Yearly counts from daily sketches, next to the exact ones: whether they are within the stated error."""
    merged = sketches.merge(sketched(spark, sf_dir), [F.year("review_date").alias("year")])
    exact = cleaned(spark, sf_dir).groupBy(F.year("review_date").alias("year"))
    exact = exact.agg(F.count_distinct("product_id").alias("products"), F.count_distinct("customer_id").alias("customers"))
    errors = [F.abs(sketches.distinct_estimate(c) / F.col(n) - 1) <= sketches.DISTINCT_ERROR for c, n in (("product_id", "products"), ("customer_id", "customers"))]
    return merged.join(exact, "year").select("year", "rows", "products", "customers", (errors[0] & errors[1]).alias("within"))


@query(
    "length_describe_merged",
    CLEANED_PARTS
    + """SELECT CAST(year(review_date) AS INT) AS "year", count(*) AS "count", round(avg(length(product_title)), 6) AS mean,
           round(stddev_samp(length(product_title)), 6) AS std, CAST(min(length(product_title)) AS DOUBLE) AS low,
           CAST(max(length(product_title)) AS DOUBLE) AS high, true AS within FROM cleaned GROUP BY 1""",
)
def length_describe_merged(spark, sf_dir):
    """Yearly figures of the title lengths from daily sketches; quartiles by whether their rank is within the error."""
    merged = sketches.merge(sketched(spark, sf_dir), [F.year("review_date").alias("year")])
    quartiles = [sketches.quantile_estimate("title_length", q).alias(f"q{i}") for i, q in enumerate(profiling.QUARTILES)]
    merged = merged.select("*", *quartiles)
    lengths = cleaned(spark, sf_dir).select(F.year("review_date").alias("year"), F.length("product_title").alias("value"))
    ranks = lengths.join(merged.select("year", *[f"q{i}" for i in range(3)]), "year").groupBy("year")
    shares = [f(F.when(test, 1.0).otherwise(0.0)).alias(f"{n}{i}") for i in range(3) for n, f, test in (("below", F.avg, F.col("value") < F.col(f"q{i}")), ("upto", F.avg, F.col("value") <= F.col(f"q{i}")))]
    within = F.lit(True)
    for i, q in enumerate(profiling.QUARTILES):
        within = within & (F.col(f"below{i}") <= q + sketches.RANK_ERROR) & (F.col(f"upto{i}") >= q - sketches.RANK_ERROR)
    figures = merged.select(
        "year",
        F.col("title_length_n").alias("count"),
        F.col("title_length_mean").alias("mean"),
        sketches.deviation("title_length").alias("std"),
        F.col("title_length_min").alias("low"),
        F.col("title_length_max").alias("high"),
    )
    return rounded(figures.join(ranks.agg(*shares), "year").withColumn("within", within).select(*figures.columns, "within"), "mean", "std")


@query("distinct_rows", CLEANED_PARTS + "SELECT DISTINCT customer_id FROM cleaned")
def distinct_rows(spark, sf_dir):
    return profiling.distinct_rows(cleaned(spark, sf_dir), ["customer_id"])


@query(
    "avg_reviews_ratios",
    CLEANED_PARTS
    + """SELECT round(count(*) / count(DISTINCT customer_id)::DOUBLE, 6) AS per_user,
           round(count(*) / count(DISTINCT product_id)::DOUBLE, 6) AS per_product FROM cleaned""",
)
def avg_reviews_ratios(spark, sf_dir):
    return rounded(profiling.average_reviews(cleaned(spark, sf_dir)), "per_user", "per_product")


@query(
    "summary_statistics",
    CLEANED_PARTS
    + """SELECT unnest(['Distinct Products Count', 'Distinct Customers Count', 'Average Rating',
                   'Average Reviews per User', 'Average Reviews per Product']) AS metric,
           unnest([round(count(DISTINCT product_id)::DOUBLE, 6), round(count(DISTINCT customer_id)::DOUBLE, 6),
                   round(avg(star_rating), 6), round(count(*) / count(DISTINCT customer_id)::DOUBLE, 6),
                   round(count(*) / count(DISTINCT product_id)::DOUBLE, 6)]) AS "value"
    FROM cleaned""",
)
def summary_statistics(spark, sf_dir):
    return rounded(profiling.summary_statistics(cleaned(spark, sf_dir)), "value")


HIST = """hist AS (
  SELECT review_count, count(*) AS user_count
  FROM (SELECT customer_id, count(star_rating) AS review_count FROM prepared GROUP BY customer_id)
  GROUP BY review_count)"""


@query("reviews_per_user_hist", extended(PREPARED_PARTS, HIST) + "SELECT * FROM hist")
def reviews_per_user_hist(spark, sf_dir):
    return profiling.reviews_per_user(cleaning.prepare_reviews(reviews(spark, sf_dir)))


@query(
    "win_cumulative_users",
    extended(PREPARED_PARTS, HIST)
    + "SELECT *, CAST(sum(user_count) OVER (ORDER BY review_count) AS BIGINT) AS cumulative_user_count FROM hist",
)
def win_cumulative_users(spark, sf_dir):
    return profiling.reviews_per_user(cleaning.prepare_reviews(reviews(spark, sf_dir)), cumulative=True)


@query(
    "category_share",
    CLEANED_PARTS
    + """SELECT category, "count", round("count" / total, 6) AS share, printf('%.2f%%', "count" / total * 100) AS percent
    FROM (SELECT category, count(*) AS "count", sum(count(*)) OVER ()::DOUBLE AS total FROM cleaned GROUP BY category)""",
)
def category_share(spark, sf_dir):
    return rounded(profiling.category_share(cleaned(spark, sf_dir)), "share")


@query(
    "daily_sentiment_counts",
    LABELLED_PARTS + 'SELECT sentiment, review_date, count(*) AS "count" FROM labelled GROUP BY sentiment, review_date',
)
def daily_sentiment_counts(spark, sf_dir):
    return profiling.daily_sentiment_counts(labelled(spark, sf_dir))


@query(
    "series_date_bounds",
    LABELLED_PARTS + "SELECT category, min(ds) AS first_day, max(ds) AS last_day FROM labelled GROUP BY category",
)
def series_date_bounds(spark, sf_dir):
    return profiling.date_bounds(labelled(spark, sf_dir), "ds", ["category"])


@query(
    "null_row_ratio",
    WIDE_PARTS
    + """SELECT round(avg(CASE WHEN negative_count IS NULL OR neutral_count IS NULL OR positive_count IS NULL
                          OR gap IS NULL THEN 1::DOUBLE ELSE 0::DOUBLE END), 6) AS null_row_ratio FROM panel""",
)
def null_row_ratio(spark, sf_dir):
    return rounded(profiling.null_row_ratio(panel.build_panel(reviews(spark, sf_dir), ["category"])), "null_row_ratio")


@query(
    "null_matrix",
    WIDE_PARTS
    + """SELECT series_id, "year", count(*) FILTER (WHERE negative_count IS NULL) AS negative_count_nulls,
           count(*) FILTER (WHERE neutral_count IS NULL) AS neutral_count_nulls,
           count(*) FILTER (WHERE positive_count IS NULL) AS positive_count_nulls,
           count(*) FILTER (WHERE gap IS NULL) AS gap_nulls
    FROM panel GROUP BY series_id, "year\"""",
)
def null_matrix(spark, sf_dir):
    columns = ["negative_count", "neutral_count", "positive_count", "gap"]
    return profiling.null_matrix(panel.build_panel(reviews(spark, sf_dir), ["category"]), columns, ["series_id", "year"])


@query(
    "yearly_box_stats",
    WIDE_PARTS
    + """SELECT series_id, "year", min(gap) AS "min", round(quantile_cont(gap, 0.25), 6) AS q1,
           round(quantile_cont(gap, 0.5), 6) AS "median", round(quantile_cont(gap, 0.75), 6) AS q3, max(gap) AS "max"
    FROM panel WHERE gap IS NOT NULL GROUP BY series_id, "year\"""",
)
def yearly_box_stats(spark, sf_dir):
    stats = profiling.box_stats(panel.build_panel(reviews(spark, sf_dir), ["category"]), "gap", ["series_id", "year"])
    return rounded(stats, "q1", "median", "q3")


DESCRIBE = """count(*) AS "count", round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std, CAST(min(n) AS INT) AS "min",
       round(quantile_cont(n, 0.25), 6) AS q1, round(quantile_cont(n, 0.5), 6) AS "median",
       round(quantile_cont(n, 0.75), 6) AS q3, CAST(max(n) AS INT) AS "max\""""


def lengths(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(F.length("text").alias("text_length"))


@query("length_describe", f"SELECT {DESCRIBE} FROM (SELECT length(text) AS n FROM documents)")
def length_describe(spark, sf_dir):
    return rounded(profiling.describe(lengths(spark, sf_dir), "text_length"), "mean", "std", "q1", "median", "q3")


@query(
    "length_histogram",
    """WITH v AS (SELECT length(text) AS n FROM documents),
    b AS (SELECT min(n) AS low, (max(n) - min(n)) / 1000::DOUBLE AS width FROM v)
    SELECT CAST(least(floor((n - low) / width), 999) AS INT) AS bin,
           round(any_value(low + least(floor((n - low) / width), 999) * width), 6) AS bin_start, count(*) AS "count"
    FROM v, b GROUP BY 1""",
)
def length_histogram(spark, sf_dir):
    return rounded(profiling.histogram(lengths(spark, sf_dir), "text_length"), "bin_start")


@query(
    "accuracy",
    """SELECT lang, round(avg(CASE WHEN quality = 1 - toxic THEN 1::DOUBLE ELSE 0::DOUBLE END), 6) AS accuracy, count(*) AS scored
    FROM labels JOIN documents USING (doc_id) GROUP BY lang""",
)
def accuracy(spark, sf_dir):
    """How often text without toxic content is good text, by language."""
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id")
    guess = rows.withColumn("guess", 1 - F.col("toxic"))
    return rounded(metrics.accuracy(guess, "quality", "guess", ["lang"]), "accuracy")


# Windows, sorts, top-k


@query(
    "win_count_per_user",
    CLEANED_PARTS + f"SELECT {ALL}, count(*) OVER (PARTITION BY customer_id) AS number_of_products FROM cleaned",
)
def win_count_per_user(spark, sf_dir):
    return numbering.with_key_count(refined(spark, sf_dir), ["customer_id"])


@query(
    "win_rank_products",
    extended(CLEANED_PARTS, MASKED) + f"SELECT {ALL}, number_of_products, product_rank FROM masked",
)
def win_rank_products(spark, sf_dir):
    return numbering.ranked(refined(spark, sf_dir), ["customer_id"], "product_id")


RECENCY = 'CAST(row_number() OVER (PARTITION BY customer_id ORDER BY review_date DESC, review_id DESC) AS INT) AS "index"'


@query("win_row_number_recent", CLEANED_PARTS + f"SELECT {ALL}, {RECENCY} FROM cleaned")
def win_row_number_recent(spark, sf_dir):
    return numbering.numbered(refined(spark, sf_dir), ["customer_id"], ["review_date", "review_id"], descending=True)


@query(
    "win_mask_count",
    extended(CLEANED_PARTS, MASKED)
    + "SELECT DISTINCT customer_id, number_of_products, number_of_products_to_mask FROM masked",
)
def win_mask_count(spark, sf_dir):
    counts = cleaned(spark, sf_dir).groupBy("customer_id").agg(F.count("*").alias("number_of_products"))
    to_mask = (F.col("number_of_products") * F.lit(splitting.MASK_FRACTION)).cast("int")
    return counts.withColumn("number_of_products_to_mask", to_mask)


@query("sort_series", LABELLED_PARTS + 'SELECT sentiment, review_date, count(*) AS "count" FROM labelled GROUP BY ALL ORDER BY 1, 2')
def sort_series(spark, sf_dir):
    return profiling.daily_sentiment_counts(labelled(spark, sf_dir)).orderBy("sentiment", "review_date")


@query("sort_categories", REVIEWS_ONLY + 'SELECT category, count(*) AS "count" FROM reviews GROUP BY 1 ORDER BY 2 DESC, 1')
def sort_categories(spark, sf_dir):
    return profiling.rows_per_key(reviews(spark, sf_dir)).orderBy(F.col("count").desc(), "category")


@query(
    "head_tail",
    extended(PREPARED_PARTS, HIST)
    + """SELECT * FROM (SELECT review_count, user_count, 'head' AS part FROM hist ORDER BY review_count LIMIT 5)
    UNION ALL SELECT * FROM (SELECT review_count, user_count, 'tail' AS part FROM hist ORDER BY review_count DESC LIMIT 5)""",
)
def head_tail(spark, sf_dir):
    hist = profiling.reviews_per_user(cleaning.prepare_reviews(reviews(spark, sf_dir)))
    return profiling.head_and_tail(hist, "review_count")


@query(
    "limit_ids",
    CLEANED_PARTS
    + f"""SELECT customer_id FROM (SELECT DISTINCT customer_id FROM cleaned)
    ORDER BY {hash_sql('customer_id')}, customer_id LIMIT 500""",
)
def limit_ids(spark, sf_dir):
    """The cap of 500 customers is the operator."""
    return sampling.limit_ids(cleaned(spark, sf_dir), "customer_id", sampling.CUSTOMER_CAP)


@query("take_n_rows", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 100")
def take_n_rows(spark, sf_dir):
    """The first n rows by id are the operator."""
    return table(spark, sf_dir, "documents").select("doc_id", "text").orderBy("doc_id").limit(100)


@query(
    "topk_items_per_user",
    CLEANED_PARTS
    + """SELECT customer_id, product_id, review_id, star_rating, position FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY star_rating DESC, review_id) AS INT) AS position
      FROM cleaned) WHERE position <= 10""",
)
def topk_items_per_user(spark, sf_dir):
    order = [F.col("star_rating").desc(), F.col("review_id").asc()]
    rows = cleaned(spark, sf_dir).select("customer_id", "product_id", "review_id", "star_rating")
    return numbering.top_per_key(rows, ["customer_id"], order, 10)


# Scalar functions


@query(
    "fn_string",
    REVIEWS_ONLY
    + """SELECT review_id, lower(product_category) AS lowered, split_part(review_id, '-', 2) AS part_key,
           substr(product_title, 1, 5) AS head, CAST(length(product_title) AS INT) AS title_length,
           printf('%.2f%%', CAST(star_rating AS DOUBLE) / 5 * 100) AS percent FROM reviews""",
)
def fn_string(spark, sf_dir):
    return reviews(spark, sf_dir).select(
        "review_id",
        F.lower("product_category").alias("lowered"),
        F.split_part("review_id", F.lit("-"), F.lit(2)).alias("part_key"),
        fn.truncate_text(F.col("product_title"), 5).alias("head"),
        F.length("product_title").alias("title_length"),
        fn.percent_text(F.col("star_rating").cast("double") / 5).alias("percent"),
    )


@query(
    "fn_date",
    REVIEWS_ONLY
    + """SELECT review_id, CAST(year(review_date) AS INT) AS "year", TRY_CAST(CAST(review_date AS VARCHAR) AS DATE) AS parsed,
           CAST(len(generate_series(review_date, DATE '2001-12-31', INTERVAL 1 DAY)) AS INT) AS days_left FROM reviews""",
)
def fn_date(spark, sf_dir):
    end = F.lit("2001-12-31").cast("date")
    return reviews(spark, sf_dir).select(
        "review_id",
        F.year("review_date").alias("year"),
        fn.to_day(F.col("review_date").cast("string")).alias("parsed"),
        F.size(F.sequence("review_date", end)).alias("days_left"),
    )


@query(
    "fn_math",
    """SELECT event_id, CASE WHEN "value" > 0 THEN round(ln("value"), 6) END AS logarithm,
           CASE WHEN "value" >= 0 THEN round(sqrt("value"), 6) END AS root, CAST(trunc("value") AS INT) AS truncated,
           round("value", 1) AS rounded, round(abs("value" - 10) * abs("value" - 10), 6) AS squared FROM events""",
)
def fn_math(spark, sf_dir):
    value = F.col("value")
    rows = table(spark, sf_dir, "events").select(
        "event_id",
        fn.safe_ln(value).alias("logarithm"),
        fn.safe_sqrt(value).alias("root"),
        value.cast("int").alias("truncated"),
        F.round(value, 1).alias("rounded"),
        (F.abs(value - 10) * F.abs(value - 10)).alias("squared"),
    )
    return rounded(rows, "logarithm", "root", "squared")


@query(
    "fn_conditional",
    REVIEWS_ONLY
    + """SELECT review_id, CASE WHEN star_rating BETWEEN 2 AND 4 THEN 'middle' ELSE 'edge' END AS zone,
           category IN ('economy', 'promo') AS listed, verified_purchase = 'Y' AS verified FROM reviews""",
)
def fn_conditional(spark, sf_dir):
    return reviews(spark, sf_dir).select(
        "review_id",
        F.when(F.col("star_rating").between(2, 4), F.lit("middle")).otherwise(F.lit("edge")).alias("zone"),
        F.col("category").isin("economy", "promo").alias("listed"),
        fn.is_true(F.col("verified_purchase")).alias("verified"),
    )


@query(
    "fn_array_argmax",
    "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INT) AS argmax FROM embeddings",
)
def fn_array_argmax(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", fn.argmax_index(F.col("embedding")).alias("argmax"))


# Samples and splits


WEIGHTS = """weights AS (
  SELECT category, "count", "count" / total AS proportion, "count" / total * 20000 / "count" AS weight
  FROM (SELECT category, count(*) AS "count", sum(count(*)) OVER ()::DOUBLE AS total FROM reviews GROUP BY category))"""


@query(
    "stratum_weights",
    extended(REVIEWS_ONLY, WEIGHTS)
    + 'SELECT category, "count", round(proportion, 6) AS proportion, round(weight, 6) AS weight FROM weights',
)
def stratum_weights(spark, sf_dir):
    weights = sampling.stratum_weights(reviews(spark, sf_dir), "category", 20_000)
    return rounded(weights, "proportion", "weight")


@query(
    "stratum_weights_equal",
    REVIEWS_ONLY
    + """SELECT category, n AS "count", round(n / sum(n) OVER ()::DOUBLE, 6) AS proportion,
           round(20000::DOUBLE / count(*) OVER () / n, 6) AS weight
    FROM (SELECT category, count(*) AS n FROM reviews GROUP BY category)""",
)
def stratum_weights_equal(spark, sf_dir):
    weights = sampling.stratum_weights(reviews(spark, sf_dir), "category", 20_000, "equal")
    return rounded(weights, "proportion", "weight")


@query(
    "sample_stratified",
    REVIEWS_ONLY
    + f"""SELECT reviews.* FROM reviews JOIN (
      SELECT category, 20000::DOUBLE / count(*) OVER () / n AS weight
      FROM (SELECT category, count(*) AS n FROM reviews GROUP BY category)) USING (category)
    WHERE {hash_sql('review_id')} < weight""",
)
def sample_stratified(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    weights = sampling.stratum_weights(rows, "category", 20_000, "equal")
    return sampling.sample_by_weights(rows, "category", weights, "review_id").select(*COLUMNS)


SIZES = """counted AS (SELECT category, count(*) AS n, sum(count(*)) OVER () AS total, count(*) OVER () AS strata FROM reviews GROUP BY category),
  wanted AS (SELECT category, n, {want} AS want, floor(round({want}, 6)) AS down FROM counted),
  sizes AS (
    SELECT category, CAST(least(n, down + CASE WHEN row_number() OVER (ORDER BY want - down DESC, category) <= {rows} - sum(down) OVER ()
      THEN 1 ELSE 0 END) AS BIGINT) AS size FROM wanted)"""
PROPORTIONAL_SIZES = SIZES.format(rows=20_003, want="n / total::DOUBLE * 20003 / n * n")
EQUAL_SIZES = SIZES.format(rows=20_003, want="20003::DOUBLE / strata / n * n")


@query("stratum_sizes", extended(REVIEWS_ONLY, PROPORTIONAL_SIZES) + "SELECT category, size FROM sizes")
def stratum_sizes(spark, sf_dir):
    """Whole rows per category that add up to the size of the sample."""
    return sampling.stratum_sizes(reviews(spark, sf_dir), "category", 20_003)


def exact_sample_sql(sizes: str) -> str:
    return (
        extended(REVIEWS_ONLY, sizes)
        + f"""SELECT {ALL} FROM (
      SELECT *, row_number() OVER (PARTITION BY category ORDER BY {order_hash_sql('review_id')}) AS place FROM reviews)
    JOIN sizes USING (category) WHERE place <= size"""
    )


@query("sample_stratified_exact", exact_sample_sql(EQUAL_SIZES))
def sample_stratified_exact(spark, sf_dir):
    """Exactly as many rows of each category as its size says."""
    rows = reviews(spark, sf_dir)
    sizes = sampling.stratum_sizes(rows, "category", 20_003, "equal")
    return sampling.sample_exact(rows, "category", sizes, "review_id").select(*COLUMNS)


@query(
    "limit_ids_per_category",
    REVIEWS_ONLY
    + f"""SELECT category, customer_id FROM (
      SELECT category, customer_id, row_number() OVER (PARTITION BY category ORDER BY {order_hash_sql('customer_id')}) AS place
      FROM (SELECT DISTINCT category, customer_id FROM reviews)) WHERE place <= {sampling.CUSTOMER_CAP}""",
)
def limit_ids_per_category(spark, sf_dir):
    """Five hundred customers of each category, whichever the category's size; the cap is part of the operator."""
    pairs = reviews(spark, sf_dir).select("category", "customer_id").distinct()
    sizes = pairs.select("category").distinct().withColumn("size", F.lit(sampling.CUSTOMER_CAP).cast("bigint"))
    return sampling.sample_exact(pairs, "category", sizes, "customer_id")


@query(
    "sample_stratified_literal",
    REVIEWS_ONLY
    + f"""SELECT * FROM reviews WHERE {hash_sql('review_id')} <
      CASE category WHEN 'economy' THEN 0.5::DOUBLE WHEN 'promo' THEN 0.25::DOUBLE ELSE 0::DOUBLE END""",
)
def sample_stratified_literal(spark, sf_dir):
    return sampling.sample_by(reviews(spark, sf_dir), "category", {"economy": 0.5, "promo": 0.25}, "review_id")


@query("sample_hash", REVIEWS_ONLY + f"SELECT * FROM reviews WHERE {hash_sql('review_id')} < 0.1::DOUBLE")
def sample_hash(spark, sf_dir):
    return sampling.sample_rows(reviews(spark, sf_dir), "review_id", 0.1)


@query("sample_customers", CLEANED_PARTS + f"SELECT {ALL} FROM cleaned WHERE {hash_sql('customer_id')} < 0.1::DOUBLE")
def sample_customers(spark, sf_dir):
    return sampling.sample_entities(cleaned(spark, sf_dir), "customer_id")


@query(
    "sample_customers_capped",
    CLEANED_PARTS
    + f"""SELECT {ALL} FROM cleaned WHERE customer_id IN (
      SELECT customer_id FROM (SELECT DISTINCT customer_id FROM cleaned) WHERE {hash_sql('customer_id')} < 0.1::DOUBLE
      ORDER BY {hash_sql('customer_id')}, customer_id LIMIT 50)""",
)
def sample_customers_capped(spark, sf_dir):
    """The cap on customers is part of the operator."""
    return sampling.sample_entities(refined(spark, sf_dir), "customer_id", cap=50)


@query(
    "split_random",
    CLEANED_PARTS
    + f"SELECT {ALL}, CASE WHEN {hash_sql('review_id')} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS split FROM cleaned",
)
def split_random(spark, sf_dir):
    return splitting.split_hash(cleaned(spark, sf_dir), "review_id", splitting.RANDOM_SHARES)


@query(
    "split_mask_fraction",
    extended(CLEANED_PARTS, MASKED, SPLIT)
    + f"SELECT {ALL}, number_of_products, product_rank, number_of_products_to_mask, split FROM split_rows",
)
def split_mask_fraction(spark, sf_dir):
    return splitting.split_mask(refined(spark, sf_dir), fraction=splitting.MASK_FRACTION)


@query(
    "split_mask_row_number",
    CLEANED_PARTS
    + f"""SELECT {ALL}, CASE WHEN place <= CAST(floor(n * 0.3::DOUBLE) AS INT) THEN 'test' ELSE 'train' END AS split
    FROM (SELECT *, count(*) OVER (PARTITION BY customer_id) AS n,
                 row_number() OVER (PARTITION BY customer_id ORDER BY product_id DESC, review_id DESC) AS place FROM cleaned)""",
)
def split_mask_row_number(spark, sf_dir):
    splits = splitting.split_mask(refined(spark, sf_dir), fraction=splitting.MASK_FRACTION, ties="row_number")
    return splits.select(*COLUMNS, "split")


NESTED = """second AS (
  SELECT *, count(*) OVER (PARTITION BY customer_id) AS n2,
         rank() OVER (PARTITION BY customer_id ORDER BY product_id DESC) AS rank2
  FROM split_rows WHERE split = 'train'),
nested AS (
  SELECT * EXCLUDE (n2, rank2, split),
         CASE WHEN rank2 <= CAST(floor(n2 * 0.3::DOUBLE) AS INT) THEN 'validation' ELSE 'train' END AS split FROM second
  UNION ALL SELECT * FROM split_rows WHERE split = 'test')"""


@query("split_mask_nested", extended(CLEANED_PARTS, MASKED, SPLIT, NESTED) + f"SELECT {ALL}, split FROM nested")
def split_mask_nested(spark, sf_dir):
    return splitting.split_mask_nested(refined(spark, sf_dir))


LEAVE_LAST = f"""left_out AS (
  SELECT *, CASE "index" WHEN 1 THEN 'test' WHEN 2 THEN 'validation' ELSE 'train' END AS split
  FROM (SELECT *, {RECENCY} FROM cleaned))"""


@query("split_leave_last", extended(CLEANED_PARTS, LEAVE_LAST) + f"SELECT {ALL}, split FROM left_out")
def split_leave_last(spark, sf_dir):
    return splitting.split_leave_last(refined(spark, sf_dir))


@query(
    "split_holdout_text",
    f"""SELECT doc_id, CASE WHEN h < 0.4::DOUBLE THEN 'train' WHEN h < 0.8::DOUBLE THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT doc_id, {hash_sql('doc_id')} AS h FROM documents)""",
)
def split_holdout_text(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id")
    return splitting.split_hash(documents, "doc_id", splitting.HOLDOUT_SHARES)


@query(
    "split_counts",
    extended(CLEANED_PARTS, LEAVE_LAST)
    + """SELECT NULL::INT AS customer_id, split, count(*) AS "rows" FROM left_out GROUP BY split
    UNION ALL SELECT customer_id, split, count(*) AS "rows" FROM left_out GROUP BY customer_id, split""",
)
def split_counts(spark, sf_dir):
    """Rows per split, for all customers (null) and for each."""
    per_customer = splitting.split_counts(splitting.split_leave_last(refined(spark, sf_dir)), ["customer_id", "split"])
    overall = per_customer.groupBy("split").agg(F.sum("rows").alias("rows"))
    return overall.withColumn("customer_id", F.lit(None).cast("int")).unionByName(per_customer)


@query(
    "index_items",
    CLEANED_PARTS
    + """SELECT product_id, CAST(row_number() OVER (ORDER BY item_rows DESC, product_id) - 1 AS INT) AS item_id, item_rows
    FROM (SELECT product_id, count(*) AS item_rows FROM cleaned GROUP BY product_id)""",
)
def index_items(spark, sf_dir):
    return fit_item_index(refined(spark, sf_dir))
