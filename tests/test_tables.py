"""Cleaning, sources, samples and metrics on small hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from reviewmill.functions import columns as fn
from reviewmill.operators import cleaning, metrics, profiling, sampling, splitting
from reviewmill.plans import panel
from reviewmill.sources import readers, writers
from reviewmill.sources.fixture import reviews

TEXT = ", ".join(f"{c} string" for c in readers.REVIEW_COLUMNS)


def review(customer="1", rating="5", verified="Y", number=0):
    return (customer, f"P{number}", rating, "toys", "2001-02-03", verified, f"R{number}", "title", "Toys")


def test_bad_text_is_dropped_not_raised(spark):
    made = [review(verified=v, number=i) for i, v in enumerate(["Y", "N", "true", "bogus", None, "1"])]
    made += [review(rating="x", number=10), review(rating=None, number=11), review(customer="a", number=12)]
    rows = spark.createDataFrame(made, TEXT)
    kept = cleaning.prepare_reviews(rows)
    assert sorted(r.review_id for r in kept.collect()) == ["R0", "R2", "R5"]
    assert dict(kept.dtypes)["star_rating"] == "float" and dict(kept.dtypes)["customer_id"] == "bigint"
    funnel = [r.value for r in cleaning.cleaning_funnel(rows).orderBy("step").collect()]
    assert funnel == [9, 5, 3, 3]
    assert [r.removed for r in cleaning.funnel_removed(cleaning.cleaning_funnel(rows)).orderBy("step").collect()] == [4, 2, 0]


def test_funnel_of_no_rows(spark):
    rows = spark.createDataFrame([], TEXT)
    assert [r.value for r in cleaning.cleaning_funnel(rows).orderBy("step").collect()] == [0, 0, 0, 0]


def test_funnel_agrees_with_the_chain(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    last = cleaning.cleaning_funnel(rows).filter("step = 4").first().value
    assert last == cleaning.clean_reviews(rows).count()


@pytest.mark.parametrize("rating, label", [(1.0, "negative"), (2.0, "negative"), (3.0, "neutral"), (4.0, "positive"), (None, None)])
def test_sentiment(spark, rating, label):
    row = spark.createDataFrame([(rating,)], "rating double").select(fn.sentiment_label(F.col("rating"))).first()
    assert row[0] == label


def test_lines_with_too_many_fields_are_skipped_and_short_ones_filled(spark, tmp_path):
    header = "\t".join(c for c in readers.REVIEW_COLUMNS if c != "category")
    good = "\t".join(["1", "P1", "5", "2001-02-03", "Y", "R1", "title", "Toys"])
    lines = [header, good, good + "\textra\tfields", "2\tP2\t4"]
    (tmp_path / "reviews_us_Home_Care_v1_00.tsv").write_text("\n".join(lines) + "\n")
    rows = readers.read_reviews(spark, str(tmp_path), category_from_file=True)
    assert rows.count() == 2
    got = {r.customer_id: r for r in rows.collect()}
    assert got["1"].category == "home_care" and got["1"].product_category == "Toys"
    assert got["2"].product_id == "P2" and got["2"].review_id is None
    columns = [c for c in readers.REVIEW_COLUMNS if c != "category"]
    assert readers.read_rejected(spark, str(tmp_path), columns).first().line.endswith("extra\tfields")


def test_metrics_equal_spark_evaluator(spark):
    rows = spark.range(200).select((F.col("id") % 7 + 1).cast("double").alias("y"), (F.col("id") % 5).cast("double").alias("p"))
    mine = metrics.regression_metrics(rows, "y", "p").first()
    for name in ("rmse", "mae"):
        evaluator = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name)
        assert mine[name] == pytest.approx(evaluator.evaluate(rows))
    assert mine.predictions == 200


def test_percentage_error_of_zero(spark):
    rows = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, p double")
    assert metrics.regression_metrics(rows, "y", "p").first().mape > 1e14
    assert metrics.regression_metrics(rows, "y", "p", zero="null").first().mape == 0.5


def test_best_is_the_lowest_and_not_the_last(spark):
    rows = spark.createDataFrame([(3.0, 1, "a"), (1.0, 2, "b"), (2.0, 3, "c"), (float("nan"), 4, "d")], "mae double, k int, name string")
    best = metrics.best_by_metric(rows, "mae", ["k", "name"]).first()
    assert (best.mae, best.k, best.name) == (1.0, 2, "b")


def test_describe_and_histogram(spark):
    rows = spark.createDataFrame([(v,) for v in [1, 2, 2, 3, 10, None]], "n int")
    d = profiling.describe(rows, "n").first()
    assert (d["count"], d["min"], d["max"], d["median"]) == (5, 1, 10, 2.0)
    assert d["mean"] == pytest.approx(3.6) and d["std"] == pytest.approx(3.646917, abs=1e-6)
    bins = {r.bin: r["count"] for r in profiling.histogram(rows, "n", 3).collect()}
    assert bins == {0: 4, 2: 1}
    flat = profiling.histogram(spark.createDataFrame([(4,), (4,)], "n int"), "n", 3).first()
    assert (flat.bin, flat["count"]) == (0, 2)


def test_splits_are_complete_and_repeatable(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    splits = splitting.split_hash(rows, "review_id", splitting.HOLDOUT_SHARES)
    shares = {r.split: r.rows / rows.count() for r in splitting.split_counts(splits).collect()}
    assert shares["test"] == pytest.approx(0.2, abs=0.02) and sum(shares.values()) == pytest.approx(1.0)
    again = splitting.split_hash(rows.repartition(5), "review_id", splitting.HOLDOUT_SHARES)
    key = ["review_id", "split"]
    assert sorted(map(tuple, splits.select(*key).collect())) == sorted(map(tuple, again.select(*key).collect()))


def test_nested_split_shares(spark, sf_dir):
    rows = cleaning.clean_reviews(reviews(spark, sf_dir))
    counts = {r.split: r.rows for r in splitting.split_counts(splitting.split_mask_nested(rows)).collect()}
    total = sum(counts.values())
    assert total == rows.count()
    assert counts["train"] / total == pytest.approx(0.49, abs=0.05)


def test_sample_weights(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    proportional = {r.weight for r in sampling.stratum_weights(rows, "category", 600).select(F.round("weight", 9).alias("weight")).collect()}
    assert proportional == {0.1}
    equal = sampling.stratum_weights(rows, "category", 600, "equal").collect()
    assert all(r.weight * r["count"] == pytest.approx(100) for r in equal)
    with pytest.raises(ValueError):
        sampling.stratum_weights(rows, "category", 600, "other")


def test_capped_customers(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    capped = sampling.sample_entities(rows, "customer_id", 0.5, cap=7)
    assert capped.select("customer_id").distinct().count() == 7
    whole = sampling.sample_entities(rows, "customer_id", 0.5)
    assert capped.join(whole, "review_id", "left_anti").count() == 0


def test_days_are_filled_within_each_series(spark):
    rows = spark.createDataFrame(
        [("a", "2001-01-01", 1), ("a", "2001-01-04", 2), ("b", "2001-03-01", 3)], "series_id string, ds string, n int"
    ).withColumn("ds", F.to_date("ds"))
    filled = panel.fill_days(rows).orderBy("series_id", "ds").collect()
    assert [(r.series_id, r.n) for r in filled] == [("a", 1), ("a", None), ("a", None), ("a", 2), ("b", 3)]


def test_approximate_distinct_counts_are_near(spark, sf_dir):
    rows = reviews(spark, sf_dir)
    exact, near = profiling.distinct_counts(rows).first(), profiling.distinct_counts(rows, approximate=True).first()
    assert near.customers == pytest.approx(exact.customers, rel=0.15)


def test_rows_without_a_prediction_are_asked_for(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, None), (5.0, float("nan")), (None, 4.0)], "y double, p double")
    row = metrics.regression_metrics(rows, "y", "p").first()
    assert (row.rmse, row.mae, row.predictions, row.asked) == (1.0, 1.0, 1, 3)
    none = metrics.regression_metrics(rows.filter("p is null"), "y", "p").first()
    assert (none.rmse, none.predictions, none.asked) == (None, 0, 1)


def test_a_large_name_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 8).selectExpr("id", "repeat(md5(string(id)), 4) AS filler", "if(id % 50 = 0, 'b.tsv', 'a.tsv') AS file")
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "100k")
    try:
        writers.write_named_tsv(rows, str(tmp_path / "named"), "file")
    finally:
        spark.conf.set(setting, before)
    names = [p.name for p in (tmp_path / "named").iterdir() if p.name.endswith(".tsv")]
    assert {"a.tsv", "b.tsv"} <= set(names) and sum(n.endswith("a.tsv") for n in names) > 1
    assert spark.read.csv(str(tmp_path / "named"), sep="\t", header=True).count() == 20_000
