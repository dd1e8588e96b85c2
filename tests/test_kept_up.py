"""Samples of exact size, sketches, counts by load, the stored history, and long lags."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill.functions.columns import order_hash
from reviewmill.operators import sampling, sketches
from reviewmill.plans import diagnostics, incremental, panel
from reviewmill.sources import history
from reviewmill.sources.readers import read_reviews


def strata(spark):
    """A hot stratum, a null one, small ones, repeated ids and a column named like the operator's own."""
    rows = [("hot", f"h{i}", i) for i in range(3000)] + [(None, f"n{i}", i) for i in range(50)]
    rows += [("few", f"f{i}", i) for i in range(3)] + [("same", "x", i) for i in range(40)]
    return spark.createDataFrame(rows, "kind string, id string, last int").repartition(7)


def sizes_of(spark, wanted):
    return spark.createDataFrame(list(wanted.items()), "kind string, size long")


WANTED = {"hot": 777, None: 20, "few": 10, "same": 7, "absent": 5}


def test_exact_sample_has_the_sizes(spark):
    rows = strata(spark)
    found = sampling.sample_exact(rows, "kind", sizes_of(spark, WANTED), "id").collect()
    counts = {k: sum(r.kind == k for r in found) for k in ("hot", None, "few", "same")}
    assert counts == {"hot": 777, None: 20, "few": 3, "same": 7}
    assert len(set(found)) == len(found) and set(found) <= set(rows.collect())


def test_exact_sample_takes_the_smallest_hashes_and_grows(spark):
    rows = strata(spark).filter("kind = 'hot'")
    order = [r.id for r in rows.orderBy(order_hash(F.col("id"), sampling.SEED)).collect()]
    for n in (1, 2, 500, 2999, 3000):
        found = {r.id for r in sampling.sample_exact(rows, "kind", sizes_of(spark, {"hot": n}), "id").collect()}
        assert found == set(order[:n])
    assert sampling.sample_exact(rows, "kind", sizes_of(spark, {"hot": 0}), "id").count() == 0
    assert sampling.sample_exact(rows.limit(0), "kind", sizes_of(spark, WANTED), "id").count() == 0


@pytest.mark.parametrize("allocation, n", [("proportional", 1001), ("equal", 33), ("proportional", 10**6)])
def test_sizes_add_up(spark, allocation, n):
    rows = strata(spark)
    counts = {r.kind: r["count"] for r in rows.groupBy("kind").count().collect()}
    sizes = {r.kind: r.size for r in sampling.stratum_sizes(rows, "kind", n, allocation).collect()}
    assert all(0 <= sizes[k] <= counts[k] for k in counts)
    if allocation == "proportional":
        assert sum(sizes.values()) == min(n, 3093)
        assert all(abs(sizes[k] - min(1.0, n / 3093) * counts[k]) <= 1 for k in counts)


def test_merged_sketches_equal_those_of_all_rows(spark):
    rng = np.random.default_rng(1)
    values = rng.gamma(2.0, 1e6, 6000) + 1e9
    rows = spark.createDataFrame([(i % 30, f"c{i % 2500}", float(v)) for i, v in enumerate(values)], "day int, customer string, v double")
    rows = rows.union(spark.createDataFrame([(3, None, None)], rows.schema))
    daily = sketches.sketch(rows, ["day"], ["customer"], ["v"])
    merged = sketches.merge(daily).select("*", sketches.distinct_estimate("customer").alias("d"), sketches.deviation("v").alias("s"), sketches.quantile_estimate("v", 0.5).alias("q")).first()
    assert merged.rows == 6001 and merged.v_n == 6000
    assert abs(merged.d / 2500 - 1) <= sketches.DISTINCT_ERROR
    assert merged.v_mean == pytest.approx(values.mean()) and merged.s == pytest.approx(values.std(ddof=1), rel=1e-9)
    assert (merged.v_min, merged.v_max) == (values.min(), values.max())
    assert abs((values <= merged.q).mean() - 0.5) <= sketches.RANK_ERROR


def test_a_repeated_load_takes_its_own_place(spark, tmp_path):
    rows = spark.range(100).withColumn("day", F.col("id") % 5)
    for load, part in (("a", rows.filter("id < 40")), ("b", rows.filter("id >= 40")), ("b", rows.filter("id >= 40"))):
        sketches.write_load(sketches.sketch(part, ["day"], ["id"]), str(tmp_path), load)
    assert sketches.merge(sketches.read_loads(spark, str(tmp_path))).first().rows == 100


COLUMNS = ("star_rating", "review_date", "category")


def write_file(path, lines):
    path.write_text("\n".join(["\t".join(COLUMNS), *("\t".join(line) for line in lines)]) + "\n")


def test_new_files_are_counted_once(spark, tmp_path):
    folder, state = tmp_path / "reviews", str(tmp_path / "state")
    folder.mkdir()
    lines = [("5", "2001-01-01", "a"), ("1", "2001-01-01", "a"), ("3", "2001-01-04", "a"), ("4", "2001-01-02", "b"), ("x", "2001-01-02", "b")]

    def update():
        incremental.update_counts(read_reviews(spark, str(folder), COLUMNS, stream=True), state, ["category"])
        return sorted(incremental.counted_panel(spark, state).collect())

    def at_once():
        return sorted(panel.build_panel(read_reviews(spark, str(folder), COLUMNS), ["category"]).collect())

    write_file(folder / "one.tsv", lines)
    first = update()
    assert first == at_once() == update()
    # The same days again, an earlier day, a damaged line and a new series.
    write_file(folder / "two.tsv", [*lines[:2], ("2", "2000-12-30", "a"), ("5", "2001-01-01", "c"), ("5", "2001-01-01", "c", "more", "more")])
    second = update()
    assert second == at_once() == update() and second != first
    counts = {(r.sentiment, r.review_date): r["count"] for r in incremental.daily_sentiments(spark, state).collect()}
    assert counts[("positive", dt.date(2001, 1, 1))] == 3


def test_look_up_reads_one_bucket(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") % 400 + 3_000_000_000).alias("customer_id"), F.col("id").alias("review"))
    history.write_history(rows, "history_test", str(tmp_path / "history"), buckets=8)
    found = history.look_up(spark, "history_test", [3_000_000_007])
    # The files of other buckets are left out of the scan: one task, where the whole table takes several.
    assert found.rdd.getNumPartitions() == 1 < spark.table("history_test").rdd.getNumPartitions()
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    plan = history.look_up(spark, "history_test", [3_000_000_007])._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in plan and "PushedFilters" in plan
    assert sorted(r.review for r in found.collect()) == list(range(7, 5000, 400))
    several = history.look_up(spark, "history_test", [3_000_000_000, 3_000_000_001, 5])
    assert several.count() == 13 + 13


def direct_products(c, lags):
    return [float(np.dot(c[k:], c[: len(c) - k])) for k in range(min(lags, len(c) - 1) + 1)]


@pytest.mark.parametrize("n, lags", [(1, 3), (2, 1), (10, 4), (1000, 999), (2048, 1000)])
def test_products_of_the_transform(n, lags):
    c = np.random.default_rng(n).normal(size=n) * 1e3
    last = min(lags, n - 1)
    assert diagnostics.lag_products(c, last) == pytest.approx(direct_products(c, last), abs=1e-9 * float(c @ c))


def test_constant_series_has_no_autocorrelation(spark):
    rows = spark.createDataFrame([("s", dt.date(2000, 1, i + 1), 4.0) for i in range(5)], "series_id string, ds date, y double")
    assert all(r.acf is None for r in diagnostics.acf(rows, 3).collect())
