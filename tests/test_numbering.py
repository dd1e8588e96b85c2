"""Positions within a key, with one key that owns two thirds of the rows."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from reviewmill.operators import numbering, splitting
from reviewmill.operators.recommend import fit_item_index

RANGES = 64


@pytest.fixture(scope="module")
def skewed(spark):
    key = F.when(F.col("id") % 3 < 2, F.lit(7)).when(F.col("id") % 31 > 0, F.col("id") % 50).cast("int")
    item = F.concat(F.lit("P"), F.pmod(F.xxhash64("id"), F.lit(400)))
    day = F.date_add(F.lit("2001-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(90)).cast("int"))
    rows = spark.range(9000).select(key.alias("customer_id"), item.alias("product_id"), day.alias("review_date"))
    return rows.withColumn("review_id", F.concat_ws("-", "product_id", F.monotonically_increasing_id())).cache()


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_hot_key_is_split(skewed):
    dealt = numbering.in_ranges(skewed, ["customer_id"], [F.col("review_id").asc()], RANGES)
    sizes = dealt.groupBy("customer_id", "_range").count()
    assert sizes.filter("customer_id = 7").count() > 20
    assert sizes.agg(F.max("count")).first()[0] < 3 * 9000 / RANGES


@pytest.mark.parametrize("ranges", [RANGES, 1, None])
@pytest.mark.parametrize("descending", [True, False])
def test_rank_equals_window(skewed, ranges, descending):
    order = F.col("product_id").desc() if descending else F.col("product_id").asc()
    by_user = Window.partitionBy("customer_id")
    expected = skewed.withColumn("product_rank", F.rank().over(by_user.orderBy(order)))
    expected = expected.withColumn("number_of_products", F.count("*").over(by_user))
    actual = numbering.ranked(skewed, ["customer_id"], "product_id", descending, ranges=ranges)
    columns = ["customer_id", "review_id", "product_rank", "number_of_products"]
    assert rows(actual, *columns) == rows(expected, *columns)


@pytest.mark.parametrize("ranges", [RANGES, 1, None])
@pytest.mark.parametrize("descending", [True, False])
def test_number_equals_window(skewed, ranges, descending):
    turn = (lambda c: F.col(c).desc()) if descending else F.col
    order = Window.partitionBy("customer_id").orderBy(turn("review_date"), turn("review_id"))
    expected = skewed.withColumn("index", F.row_number().over(order))
    actual = numbering.numbered(skewed, ["customer_id"], ["review_date", "review_id"], descending, ranges=ranges)
    assert rows(actual, "customer_id", "review_id", "index") == rows(expected, "customer_id", "review_id", "index")


def test_number_comes_with_the_count_of_the_key(skewed):
    expected = numbering.with_key_count(numbering.numbered(skewed, ["customer_id"], ["product_id", "review_id"]), ["customer_id"])
    actual = numbering.numbered(skewed, ["customer_id"], ["product_id", "review_id"], count_name="number_of_products")
    columns = ["customer_id", "review_id", "index", "number_of_products"]
    assert rows(actual, *columns) == rows(expected, *columns)


def test_nested_masks_join_the_rows_once(skewed):
    """Both masks are laid over customers and products; the rows meet the outcome in one join."""
    split = splitting.split_mask_nested(skewed, ranges=RANGES)
    assert split.columns == [*skewed.columns, "split"]
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") == 1
    first = splitting.split_mask(skewed, fraction=splitting.MASK_FRACTION, ranges=RANGES)
    rest = first.filter("split = 'train'").select(*skewed.columns)
    second = splitting.split_mask(rest, fraction=splitting.MASK_FRACTION, masked="validation", ranges=RANGES)
    expected = rows(first.filter("split = 'test'"), "review_id", "split") + rows(second, "review_id", "split")
    assert rows(split, "review_id", "split") == sorted(expected, key=repr)


def test_item_codes_are_dense_and_by_frequency(skewed):
    expected = skewed.groupBy("product_id").agg(F.count("*").alias("n"))
    order = Window.orderBy(F.col("n").desc(), "product_id")
    expected = expected.withColumn("item_id", F.row_number().over(order) - 1)
    assert rows(fit_item_index(skewed, ranges=50), "product_id", "item_id") == rows(expected, "product_id", "item_id")


def test_item_codes_equal_string_indexer(skewed):
    from pyspark.ml.feature import StringIndexer

    labels = StringIndexer(inputCol="product_id", outputCol="i").fit(skewed).labels
    codes = {r.item_id: r.product_id for r in fit_item_index(skewed).collect()}
    assert [codes[i] for i in range(len(labels))] == labels


def test_leave_last_with_a_hot_user(skewed):
    known = skewed.filter("customer_id is not null")
    splits = splitting.split_leave_last(known)
    counts = {(r.customer_id, r.split): r.n for r in splits.groupBy("customer_id", "split").agg(F.count("*").alias("n")).collect()}
    users = {c for c, _ in counts}
    assert all(counts[(u, "test")] == 1 and counts[(u, "validation")] == 1 for u in users)
    assert splits.count() == known.count()


@pytest.mark.parametrize("ties", ["rank", "row_number"])
def test_masked_rows_reach_the_target(skewed, ties):
    known = skewed.filter("customer_id is not null")
    splits = splitting.split_mask(known, fraction=0.3, ties=ties, ranges=RANGES)
    assert splits.count() == known.count()
    per_user = splits.groupBy("customer_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("masked")
    )
    for row in per_user.collect():
        target = int(row.n * 0.3)
        assert row.masked == target if ties == "row_number" else row.masked >= target


def test_rows_without_a_key_stay(skewed):
    assert skewed.filter("customer_id is null").count() > 0
    assert numbering.with_key_count(skewed, ["customer_id"]).count() == skewed.count()
    assert splitting.split_leave_last(skewed).count() == skewed.count()
    for ties in ("rank", "row_number"):
        assert splitting.split_mask(skewed, fraction=0.3, ties=ties).count() == skewed.count()
