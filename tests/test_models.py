"""Queries without SQL: they run, and their results hold what they must."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from reviewmill.checks import models
from reviewmill.operators import cleaning, dictionaries, recommend
from reviewmill.session import shared_folder
from reviewmill.sources.fixture import reviews
from reviewmill.sources.readers import REVIEW_COLUMNS, read_reviews

QUERIES = entry.queries()
GRID = {"max_iter": [2, 4], "reg": [0.1], "rank": [3]}


@pytest.fixture(scope="module")
def trained(spark, sf_dir):
    return models.trained(spark, sf_dir)


def test_predictions_are_not_negative(trained):
    _, _, splits, model = trained
    scored = model.transform(models.part(splits, "test"))
    low = scored.agg(F.min("prediction"), F.count_if(F.isnan("prediction"))).first()
    assert low[0] >= 0 and low[1] == 0


def test_predictions_cover_known_items(trained):
    _, _, splits, model = trained
    train, test = models.part(splits, "train"), models.part(splits, "test")
    known = test.join(train.select("item_id").distinct(), "item_id", "left_semi")
    known = known.join(train.select("customer_id").distinct(), "customer_id", "left_semi")
    assert recommend.evaluate_als(model, test).first().predictions == known.count()


def test_unknown_pairs_are_asked_for_and_not_scored(spark, trained):
    model = trained[3]
    known = models.part(trained[2], "train").select("customer_id", "item_id", "star_rating").limit(5)
    unknown = spark.createDataFrame([(-7, 0, 3.0), (1, 1 << 30, 3.0)], "customer_id long, item_id int, star_rating float")
    row = recommend.evaluate_als(model, known.unionByName(unknown)).first()
    assert (row.predictions, row.asked) == (5, 7)
    assert model.getColdStartStrategy() == "drop"


def test_same_seed_same_model(trained):
    _, _, splits, model = trained
    again = recommend.train_als(models.part(splits, "train"), max_iter=15, reg=0.1, rank=15)
    test = models.part(splits, "test")
    first, second = recommend.evaluate_als(model, test).first(), recommend.evaluate_als(again, test).first()
    assert first.rmse == pytest.approx(second.rmse, rel=1e-3)


def test_recommendations_are_titled_once(trained):
    rows, index, _, model = trained
    users = recommend.distinct_users(rows)
    result = recommend.recommend(model, users, 5, index, recommend.product_titles(rows))
    per_user = result.groupBy("customer_id").agg(F.count("*").alias("n"), F.count_distinct("product_id").alias("d"))
    assert per_user.filter("n != 5 or d != 5").count() == 0
    everyone = recommend.recommend_all(model, 5, index, recommend.product_titles(rows))
    assert result.count() == everyone.count()


def test_unknown_user_has_no_recommendation(spark, trained):
    model = trained[3]
    users = spark.createDataFrame([(-5,), (-6,)], "customer_id int")
    assert recommend.users_without_recommendations(users, model).count() == 2
    asked = users.union(trained[0].select("customer_id").distinct())
    served = model.recommendForUserSubset(asked, 3)
    expected = asked.join(served, "customer_id", "left_anti").distinct()
    missing = recommend.users_without_recommendations(asked, model)
    assert sorted(missing.collect()) == sorted(expected.collect())


def test_stored_model_scores_the_same(spark, trained, tmp_path):
    _, index, splits, model = trained
    recommend.save_model(model, index, str(tmp_path / "model"))
    loaded, items = recommend.load_model(spark, str(tmp_path / "model"))
    test = models.part(splits, "test")
    assert items.count() == index.count()
    before, after = recommend.evaluate_als(model, test).first(), recommend.evaluate_als(loaded, test).first()
    assert tuple(after) == pytest.approx(tuple(before), rel=1e-12)


def best_items(users: dict, items: dict, n: int) -> dict:
    ids = sorted(items)
    matrix = np.array([items[i] for i in ids], dtype=np.float32).astype(float)
    found = {}
    for user, features in users.items():
        scores = matrix @ np.array(features, dtype=np.float32).astype(float)
        order = np.lexsort((ids, -scores))[:n]
        found[user] = [(ids[k], np.float32(scores[k])) for k in order]
    return found


def factors(spark, rows: dict):
    return spark.createDataFrame(sorted(rows.items()), "id int, features array<float>").repartition(3)


@pytest.mark.parametrize("kind", ["spread", "ties", "mixed signs"])
def test_top_items_equal_brute_force(spark, kind):
    rng = np.random.default_rng(5)
    if kind == "ties":
        users = {i: rng.integers(0, 3, 4).tolist() for i in range(120)}
        items = {i: rng.integers(0, 3, 4).tolist() for i in range(700)}
    else:
        low = -1.0 if kind == "mixed signs" else 0.0
        users = {i: rng.uniform(low, 1, 4).tolist() for i in range(120)}
        items = {i: (rng.uniform(low, 1, 4) * rng.pareto(1.5)).tolist() for i in range(700)}
    users = {i: [float(x) for x in v] for i, v in users.items()} | {500: [0.0] * 4}
    items = {i: [float(x) for x in v] for i, v in items.items()}
    found = recommend.top_items(factors(spark, users), factors(spark, items), 7, first_items=16, group_users=50).collect()
    assert {r.id: [(p.item_id, np.float32(p.rating)) for p in r.recommendations] for r in found} == best_items(users, items, 7)
    if kind == "spread":
        assert sum(r.scored for r in found if r.id != 500) < 0.5 * 120 * 700


def test_top_items_are_decided_in_double_precision(spark):
    """Scores that single precision cannot tell apart, over several blocks of items, with large and tiny users."""
    rng = np.random.default_rng(8)
    items = {i: [float(x) for x in 1 + rng.integers(0, 40, 5) * 2.0**-22] for i in range(2500)}
    users = {i: [float(x) for x in rng.uniform(0.9, 1.1, 5) * 10.0 ** rng.integers(-3, 4)] for i in range(300)}
    users |= {900: [1e-30] * 5, 901: [1e30] * 5}
    found = recommend.top_items(factors(spark, users), factors(spark, items), 10, group_users=100).collect()
    best = best_items(users, items, 10)
    assert len(found) == len(users)
    for row in found:
        # Sums of equal value up to the last bit of a double may come in another order than here.
        expected = [float(rating) for _, rating in best[row.id]]
        assert np.allclose([p.rating for p in row.recommendations], expected, rtol=1e-6)
        matrix = np.array([items[p.item_id] for p in row.recommendations], dtype=np.float32).astype(float)
        scores = matrix @ np.array(users[row.id], dtype=np.float32).astype(float)
        every = np.array([items[i] for i in sorted(items)], dtype=np.float32).astype(float) @ np.array(users[row.id], dtype=np.float32).astype(float)
        assert np.allclose(scores, -np.sort(-every)[:10], rtol=1e-13)


def test_items_travel_in_blocks(spark):
    """A group of users is sent a row for each 1024 items, not one for each item."""
    placed = spark.range(3000).selectExpr("id AS place", "id + 7 AS item", "double(5000 - id) AS length", "array(float(id), float(1)) AS features")
    rows = recommend._blocks(placed.repartition(5)).orderBy("block").collect()
    assert [(r.items, r.length) for r in rows] == [(1024, 5000.0), (1024, 3976.0), (952, 2952.0)]
    assert [i for r in rows for i in r.ids] == list(range(7, 3007))
    assert [f for r in rows for f in r.features][::2] == [float(i) for i in range(3000)]


def test_few_users_are_dealt_to_many_groups():
    """Up to 20,000 users were one group, whose pairs one core scored."""
    assert recommend._groups(16_000, recommend.GROUP_USERS) == 24 and recommend._groups(1_400, recommend.GROUP_USERS) == 3
    assert recommend._groups(1, recommend.GROUP_USERS) == 1
    # Many users as before.
    assert [recommend._groups(n, recommend.GROUP_USERS) for n in (900_000, 960_000, 5_400_000, 20_000_000)] == [45, 48, 48, 100]


def test_top_items_of_few_or_no_items(spark):
    users = factors(spark, {1: [1.0, 0.0], 2: [0.0, 0.0]})
    few = recommend.top_items(users, factors(spark, {8: [2.0, 1.0], 9: [3.0, 1.0]}), 5).collect()
    assert {r.id: [p.item_id for p in r.recommendations] for r in few} == {1: [9, 8], 2: [8, 9]}
    none = recommend.top_items(users, factors(spark, {}), 5).collect()
    assert {r.id: (r.recommendations, r.scored) for r in none} == {1: ([], 0), 2: ([], 0)}
    assert recommend.top_items(factors(spark, {}), users, 5).count() == 0


def test_recommendations_equal_the_trainers_own(trained):
    """Spark ML scores all pairs; ratings of each place agree (items may differ only where ratings tie)."""
    model = trained[3]
    mine = {r.customer_id: [p.rating for p in r.recommendations] for r in recommend.recommend_items(model, None, 10).collect()}
    theirs = {r.customer_id: [p.rating for p in r.recommendations] for r in model.recommendForAllUsers(10).collect()}
    assert set(mine) == set(theirs)
    assert all(mine[u] == pytest.approx(theirs[u], rel=1e-5) for u in mine)


def test_customers_beyond_int_from_reader_to_recommendation(spark, sf_dir, tmp_path):
    raw = reviews(spark, sf_dir).withColumn("customer_id", (F.col("customer_id") + F.lit(3_000_000_000)).cast("string"))
    raw.select(*REVIEW_COLUMNS).write.csv(str(tmp_path / "reviews"), sep="\t", header=True)
    rows = cleaning.clean_reviews(read_reviews(spark, str(tmp_path / "reviews"))).cache()
    assert rows.agg(F.min("customer_id")).first()[0] >= 3_000_000_000
    paths = [str(tmp_path / "users"), str(tmp_path / "items")]
    dictionaries.extend_codes(rows, paths[0], "customer_id", "user_code")
    dictionaries.extend_codes(rows, paths[1], "product_id", "item_id")
    users = dictionaries.read_codes(spark, paths[0], "customer_id", "user_code")
    items = dictionaries.read_codes(spark, paths[1], "product_id", "item_id", "string")
    coded = dictionaries.with_codes(dictionaries.with_codes(rows, users, "customer_id", "user_code"), items, "product_id", "item_id")
    assert coded.count() == rows.count()
    model = recommend.train_als(coded, max_iter=2, rank=3, user="user_code")
    asked = rows.select("customer_id").distinct().limit(5)
    found = recommend.recommend_coded(model, asked, 4, users, items, recommend.product_titles(rows)).collect()
    assert sorted({r.customer_id for r in found}) == sorted(r[0] for r in asked.collect()) and len(found) == 20


def test_codes_never_change(spark, tmp_path):
    path = str(tmp_path / "codes")

    def load(keys):
        version = dictionaries.extend_codes(spark.createDataFrame([(k,) for k in keys], "k string"), path, "k", "code")
        return version, {r.k: r.code for r in dictionaries.read_codes(spark, path, "k", "code", "string").collect()}

    assert load([]) == (0, {})
    assert load(["m", "c", None, "m"]) == (1, {"c": 0, "m": 1})
    assert load(["m", None]) == (1, {"c": 0, "m": 1})
    assert load(["z", "a", "m"]) == (2, {"c": 0, "m": 1, "a": 2, "z": 3})
    assert dictionaries.read_codes(spark, path, "k", "code", "string", version=1).count() == 2
    # A load that broke off before its mark was set is not read, and written again.
    (tmp_path / "codes" / "version=2" / "_SUCCESS").unlink()
    assert dictionaries.versions(spark, path) == [1]
    assert load(["b"]) == (2, {"c": 0, "m": 1, "b": 2})


def test_grid_search_reports_every_combination(trained):
    splits = trained[2]
    rows = recommend.grid_search_als(models.part(splits, "train"), models.part(splits, "test"), GRID).collect()
    assert sorted(r.max_iter for r in rows) == [2, 4]
    assert all(r.mae > 0 and r.predictions > 0 for r in rows)


def test_trained_factors_are_read_from_a_file(spark, trained, tmp_path):
    """A model held on to what its training kept on disks: shuffled ratings and the factors of up to five rounds."""
    train = models.part(trained[2], "train")
    model = recommend.train_als(train, max_iter=2, rank=3, folder=str(tmp_path / "factors"))
    assert all(str(tmp_path / "factors") in f for x in (model.userFactors, model.itemFactors) for f in x.inputFiles())
    assert model.userFactors.count() == train.select("customer_id").distinct().count()
    assert (model.rank, model.getColdStartStrategy(), model.getUserCol()) == (3, "drop", "customer_id")
    assert recommend.CHECKPOINT_ROUNDS == 1


def test_large_trainings_are_read_from_a_file(trained, monkeypatch):
    train = models.part(trained[2], "train")
    assert not recommend.train_als(train, max_iter=1, rank=2).itemFactors.inputFiles()
    monkeypatch.setattr(recommend, "SMALL_RATINGS", train.count())
    assert recommend.train_als(train, max_iter=1, rank=2).itemFactors.inputFiles()


def test_search_deletes_the_factors_of_its_fits(spark, trained, monkeypatch):
    monkeypatch.setattr(recommend, "SMALL_RATINGS", 0)
    splits, before = trained[2], set(os.listdir(shared_folder(spark)))
    rows = recommend.grid_search_als(models.part(splits, "train"), models.part(splits, "test"), GRID).collect()
    assert len(rows) == 2 and not [x for x in set(os.listdir(shared_folder(spark))) - before if x.startswith(("fit", "factors"))]


def test_large_fits_of_a_search_run_one_by_one():
    """Four fits at a time held four times the files, however many ratings there were."""
    assert [recommend.fits_at_a_time(n, 4) for n in (0, 280_000, 12_000_000, 17_000_000, 136_000_000)] == [4, 4, 2, 1, 1]


def test_blocks_of_a_training_hold_five_million_ratings(trained, monkeypatch, tmp_path):
    """Ten blocks whatever the number of ratings were more than a task's memory takes."""
    assert [recommend.training_blocks(n) for n in (0, 280_000, 17_000_000, 50_000_001, 136_000_000)] == [10, 10, 10, 11, 28]
    train = models.part(trained[2], "train").select("customer_id", "item_id", "star_rating")
    monkeypatch.setattr(recommend, "BLOCK_RATINGS", -(-train.count() // 13))
    assert len(recommend.train_als(train, max_iter=1, rank=2, folder=str(tmp_path / "factors")).itemFactors.inputFiles()) == 13


def test_each_recipe_is_scored_before_the_next(spark, sf_dir):
    """Three models with the files of their training stayed until all were scored in one go."""
    files = models.recipes(spark, sf_dir).inputFiles()
    assert files and all("/errors-" in f for f in files)


def test_errors_of_the_recipes(spark, sf_dir):
    rows = QUERIES["als_evaluate_errors"](spark, sf_dir).collect()
    assert {(r.recipe, r.split) for r in rows} == {("random", "test"), ("masked", "test"), ("leave last", "test"), ("leave last", "validation")}
    assert all(0 < r.mae <= r.rmse < 4 and 0 < r.predictions <= r.asked for r in rows)


def test_losses_fall(spark, sf_dir):
    losses = [r.loss for r in QUERIES["train_losses"](spark, sf_dir).orderBy("round").collect()]
    assert len(losses) > 2 and losses == sorted(losses, reverse=True)


def test_wide_search_rolls_with_the_order_found(spark, sf_dir):
    rows = QUERIES["ts_arima_auto_rolling"](spark, sf_dir)
    found = rows.groupBy("series_id").agg(F.count("*").alias("days"), F.count_distinct("p", "d", "q").alias("orders"))
    assert {(r.days, r.orders) for r in found.collect()} == {(30, 1)}
    assert rows.select("p", "d", "q").distinct().count() > 1


def test_text_classifier_is_scored_on_each_part(spark, sf_dir):
    rows = {r.split: r.accuracy for r in QUERIES["text_classifier_accuracy"](spark, sf_dir).collect()}
    assert set(rows) == {"train", "validation", "test"}
    assert rows["train"] > 0.6
