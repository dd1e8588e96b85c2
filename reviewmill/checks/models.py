"""Queries that train models: the recommender and the text classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.checks.registry import CLEANED_PARTS, extended, hash_sql, query, rounded
from reviewmill.checks.tables import DESCRIBE, LEAVE_LAST, NESTED, SPLIT, refined
from reviewmill.checks.tables import MASKED as MASKED_ROWS
from reviewmill.functions import columns as fn
from reviewmill.operators import cleaning, dictionaries, metrics, profiling, recommend, splitting, text
from reviewmill.session import cut_lineage, scratch_path, tidy_disks
from reviewmill.sources.fixture import reviews, table

TOP_N = recommend.TOP_N


# What training reads, and what titles are made of.
RATED = ("customer_id", "product_id", "star_rating")
TITLED = ("product_title", "product_category")
# What tells which reviews of a customer are the latest.
LATEST = ("review_date", "review_id")


def coded(spark: SparkSession, sf_dir: str, more: Sequence[str] = (), kept: Sequence[str] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cleaned reviews, the item codes, and the masked split with codes, each written out once.

    Only what is read later is written and shuffled: ratings, columns ``more`` of the split, and ``kept`` of the reviews.
    """
    columns = [*RATED, *more]
    rows = refined(spark, sf_dir, [*columns, *kept])
    tidy_disks(spark)
    index = cut_lineage(recommend.fit_item_index(rows))
    splits = splitting.split_mask(rows.select(*columns), fraction=splitting.MASK_FRACTION)
    splits = cut_lineage(recommend.encode_items(splits, index).select(*columns, "item_id", "split"))
    tidy_disks(spark)
    return rows, index, splits


def part(splits: DataFrame, name: str) -> DataFrame:
    return splits.filter(F.col("split") == name)


def trained(spark: SparkSession, sf_dir: str, more: Sequence[str] = (), kept: Sequence[str] = TITLED):
    rows, index, splits = coded(spark, sf_dir, more, kept)
    model = recommend.train_als(part(splits, "train"), max_iter=15, reg=0.1, rank=15)
    return rows, index, splits, model


@query(
    "encode_items",
    CLEANED_PARTS
    + """SELECT review_id, product_id, item_id FROM cleaned JOIN (
      SELECT product_id, CAST(row_number() OVER (ORDER BY count(*) DESC, product_id) - 1 AS INT) AS item_id
      FROM cleaned GROUP BY product_id) USING (product_id)""",
)
def encode_items(spark, sf_dir):
    rows = refined(spark, sf_dir)
    return recommend.encode_items(rows, recommend.fit_item_index(rows)).select("review_id", "product_id", "item_id")


@query("decode_items", CLEANED_PARTS + "SELECT review_id, product_id FROM cleaned")
def decode_items(spark, sf_dir):
    """Codes turned back into products give the reviews again."""
    rows = refined(spark, sf_dir)
    index = cut_lineage(recommend.fit_item_index(rows))
    codes = recommend.encode_items(rows, index).select("review_id", "item_id")
    return recommend.decode_items(codes, index).select("review_id", "product_id")


@query(
    "product_titles",
    CLEANED_PARTS
    + """SELECT product_id, product_title, product_category FROM (
      SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_title, product_category) AS place
      FROM cleaned) WHERE place = 1""",
)
def product_titles(spark, sf_dir):
    return recommend.product_titles(refined(spark, sf_dir))


MASKED = """, masked AS (SELECT *, rank() OVER (PARTITION BY customer_id ORDER BY product_id DESC) AS place,
                count(*) OVER (PARTITION BY customer_id) AS n FROM cleaned),
    train AS (SELECT * FROM masked WHERE place > CAST(floor(n * 0.3::DOUBLE) AS INT)),
    scorable AS (SELECT * FROM masked WHERE place <= CAST(floor(n * 0.3::DOUBLE) AS INT)
      AND customer_id IN (SELECT customer_id FROM train) AND product_id IN (SELECT product_id FROM train))"""


@query("als_train", CLEANED_PARTS + MASKED + "SELECT DISTINCT product_id, CAST(10 AS INT) AS factors, true AS plausible FROM train")
def als_train(spark, sf_dir):
    """The items of the trained model: how many factors they have, and that none is negative or missing."""
    _, index, splits = coded(spark, sf_dir)
    model = recommend.train_als(part(splits, "train"))
    factors = model.itemFactors.withColumnRenamed("id", "item_id")
    sound = F.forall("features", lambda x: x.isNotNull() & (x >= 0) & (x < float("inf"))) & F.exists("features", lambda x: x > 0)
    return recommend.decode_items(factors, index).select("product_id", F.size("features").alias("factors"), sound.alias("plausible"))


@query(
    "als_predict",
    CLEANED_PARTS + MASKED + "SELECT customer_id, product_id, review_id, star_rating, true AS plausible FROM scorable",
)
def als_predict(spark, sf_dir):
    """The test reviews that get a score, and whether the score is one (factors are not negative)."""
    _, _, splits, model = trained(spark, sf_dir, ["review_id"], [])
    scored = model.transform(part(splits, "test"))
    plausible = F.col("prediction").between(0, 25).alias("plausible")
    # The model turns the columns it scores by into ints.
    return scored.select(F.col("customer_id").cast("bigint"), "product_id", "review_id", "star_rating", plausible)


def counted_sql(name: str, splits: str) -> str:
    """Rows asked for and rows with a known user and item, of the parts that do not train."""
    return f"""SELECT '{name}' AS recipe, split, count(*) AS asked, count(*) FILTER (WHERE customer_id IN (SELECT customer_id FROM {splits} WHERE split = 'train')
      AND product_id IN (SELECT product_id FROM {splits} WHERE split = 'train')) AS predictions, true AS plausible
    FROM {splits} WHERE split <> 'train' GROUP BY split"""


RANDOM_PART = f"random_part AS (SELECT *, CASE WHEN {hash_sql('review_id')} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS split FROM cleaned)"
# Ratings lie between 1 and 5 and predictions are not negative.
RATING_RANGE = 25


def plausible_ratings(errors: DataFrame) -> DataFrame:
    plausible = (F.col("mae") <= F.col("rmse") + 1e-9) & (F.col("rmse") < RATING_RANGE) & (F.col("rmse") > 0)
    return errors.withColumn("plausible", plausible).drop("rmse", "mae", "mape")


def recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the three training recipes on their test and validation parts."""
    rows, index, masked = coded(spark, sf_dir, kept=LATEST)
    needed = ["customer_id", "item_id", "star_rating", "split"]
    random = recommend.encode_items(splitting.split_hash(rows.select(*RATED, "review_id"), "review_id", splitting.RANDOM_SHARES), index).select(*needed)
    last = recommend.encode_items(splitting.split_leave_last(rows.select(*RATED, *LATEST)), index).select(*needed)
    tried = {
        "random": (random, {"max_iter": 5, "reg": 0.1, "rank": 10}),
        "masked": (masked.select(*needed), {"max_iter": 15, "reg": 0.1, "rank": 15}),
        "leave last": (last, {"max_iter": 5, "reg": 0.01, "rank": 10}),
    }
    result = None
    for name, (splits, params) in tried.items():
        splits = splits if name == "masked" else cut_lineage(splits)
        tidy_disks(spark)
        model = recommend.train_als(part(splits, "train"), **params)
        errors = recommend.evaluate_als(model, splits.filter(F.col("split") != "train"), by=["split"])
        # Scored before the next recipe begins, so that their files are not on the disks together.
        errors = cut_lineage(errors, "errors").withColumn("recipe", F.lit(name))
        result = errors if result is None else result.unionByName(errors)
        tidy_disks(spark)
    return result


@query(
    "als_evaluate",
    extended(CLEANED_PARTS, RANDOM_PART, MASKED_ROWS, SPLIT, LEAVE_LAST)
    + " UNION ALL ".join([counted_sql("random", "random_part"), counted_sql("masked", "split_rows"), counted_sql("leave last", "left_out")]),
)
def als_evaluate(spark, sf_dir):
    """Rows asked for and scored by each recipe and part, and whether the errors are plausible."""
    return plausible_ratings(recipes(spark, sf_dir))


@query("als_evaluate_errors")
def als_evaluate_errors(spark, sf_dir):
    """The errors themselves."""
    return recipes(spark, sf_dir)


def nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = refined(spark, sf_dir, RATED)
    index = cut_lineage(recommend.fit_item_index(rows))
    splits = recommend.encode_items(splitting.split_mask_nested(rows), index)
    splits = cut_lineage(splits.select("customer_id", "item_id", "star_rating", "split"))
    tidy_disks(spark)
    return splits


GRID_SQL = " CROSS JOIN ".join(
    "(SELECT unnest([" + ", ".join(f"{v}::{kind}" for v in recommend.GRID[name]) + f"]) AS {name})"
    for name, kind in (("max_iter", "INT"), ("reg", "DOUBLE"), ("rank", "INT"))
)


@query(
    "als_grid_search",
    extended(CLEANED_PARTS, MASKED_ROWS, SPLIT, NESTED)
    + f"""SELECT max_iter, reg, "rank", asked, predictions, true AS plausible, 1::BIGINT AS winners FROM ({counted_sql("nested", "nested")}) counts,
    {GRID_SQL} WHERE split = 'validation'""",
)
def als_grid_search(spark, sf_dir):
    """All 27 combinations on the validation part, and how many are marked as the best one by MAE."""
    splits = nested(spark, sf_dir)
    errors = recommend.grid_search_als(part(splits, "train"), part(splits, "validation"))
    best = metrics.best_by_metric(errors, "mae", ["max_iter", "reg", "rank"]).withColumn("best", F.lit(True))
    marked = errors.join(best.drop("mae"), ["max_iter", "reg", "rank"], "left")
    winners = F.count("best").over(Window.partitionBy(F.lit(0)))
    return plausible_ratings(marked.withColumn("winners", winners)).drop("best")


@query("als_grid_search_small")
def als_grid_search_small(spark, sf_dir):
    """The form with 9 combinations of rank one, on the leave-last split."""
    rows = refined(spark, sf_dir, [*RATED, *LATEST])
    index = cut_lineage(recommend.fit_item_index(rows))
    splits = recommend.encode_items(splitting.split_leave_last(rows), index)
    splits = cut_lineage(splits.select("customer_id", "item_id", "star_rating", "split"))
    tidy_disks(spark)
    errors = recommend.grid_search_als(part(splits, "train"), part(splits, "validation"), recommend.SMALL_GRID)
    return metrics.best_by_metric(errors, "mae", ["rmse", "predictions", "max_iter", "reg", "rank"])


SERVED = f"""SELECT customer_id, {TOP_N}::BIGINT AS items, {TOP_N}::BIGINT AS titled, true AS falling FROM train {{where}} GROUP BY customer_id"""


def served(rows: DataFrame, titled: DataFrame) -> DataFrame:
    """Per customer the distinct products, those with the title that the product has, and whether ratings are plausible."""
    known = recommend.product_titles(rows).withColumn("_known", F.lit(True))
    checked = titled.join(known, ["product_id", "product_title", "product_category"], "left")
    falling = F.min(F.col("rating").between(0, RATING_RANGE))
    return checked.groupBy("customer_id").agg(
        F.count_distinct("product_id").alias("items"), F.count("_known").alias("titled"), falling.alias("falling")
    ).withColumn("customer_id", F.col("customer_id").cast("bigint"))


@query("recommend_users", CLEANED_PARTS + MASKED + SERVED.format(where="WHERE customer_id IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"))
def recommend_users(spark, sf_dir):
    """Ten items for every customer whose balance is negative: distinct, titled, with plausible ratings."""
    rows, index, _, model = trained(spark, sf_dir)
    users = table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").cast("int").alias("customer_id"))
    return served(rows, recommend.recommend(model, users, TOP_N, index, recommend.product_titles(rows)))


@query("recommend_all", CLEANED_PARTS + MASKED + SERVED.format(where=""))
def recommend_all(spark, sf_dir):
    """The same for every customer that the model knows."""
    rows, index, _, model = trained(spark, sf_dir)
    return served(rows, recommend.recommend_all(model, TOP_N, index, recommend.product_titles(rows)))


@query("recommend_items")
def recommend_items(spark, sf_dir):
    """The ten items themselves, of every customer that the model knows."""
    rows, index, _, model = trained(spark, sf_dir)
    return recommend.recommend_all(model, TOP_N, index, recommend.product_titles(rows))


@query("recommend_scored_share")
def recommend_scored_share(spark, sf_dir):
    """How many of all pairs of users and items were scored to find the best ten of every user."""
    _, _, _, model = trained(spark, sf_dir, kept=[])
    found = recommend.recommend_items(model, None, TOP_N)
    n_items = model.itemFactors.agg(F.count("*").alias("items"))
    counted = found.agg(F.count("*").alias("users"), F.sum("scored").alias("scored")).join(n_items)
    return counted.withColumn("share", F.col("scored") / (F.col("users") * F.col("items")))


VECTORS = """buyers AS (
  SELECT c_custkey AS id, [1 + c_custkey % 13, 1 + c_custkey // 13 % 11, 1 + c_custkey // 143 % 7] AS u FROM customer),
goods AS (
  SELECT p_partkey AS id, [p_size % 17 * (p_partkey % 50 = 0)::INT + p_partkey % 5, p_size, p_partkey % 7 + 1] AS v FROM part)"""


@query(
    "recommend_top_exact",
    f"""WITH {VECTORS},
    scored AS (
      SELECT buyers.id AS customer_id, goods.id AS item_id, u[1] * v[1] + u[2] * v[2] + u[3] * v[3] AS score FROM buyers, goods),
    placed AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, item_id) AS place FROM scored)
    SELECT customer_id, CAST(item_id AS INT) AS item_id, CAST(score AS FLOAT) AS rating FROM placed WHERE place <= {TOP_N}""",
)
def recommend_top_exact(spark, sf_dir):
    """The best ten parts of every customer for factors made of whole numbers, so that ties are ties."""
    number, part = F.col("c_custkey"), F.col("p_partkey")
    digits = [1 + number % 13, 1 + F.expr("c_custkey div 13") % 11, 1 + F.expr("c_custkey div 143") % 7]
    sizes = [F.col("p_size") % 17 * (part % 50 == 0).cast("int") + part % 5, F.col("p_size"), part % 7 + 1]
    users = table(spark, sf_dir, "customer").select(number.alias("id"), F.array(*[d.cast("float") for d in digits]).alias("features"))
    items = table(spark, sf_dir, "part").select(part.alias("id"), F.array(*[d.cast("float") for d in sizes]).alias("features"))
    found = recommend.top_items(users, items, TOP_N, first_items=64)
    return found.select(F.col("id").alias("customer_id"), F.inline("recommendations"))


FAR_CUSTOMERS = 3_000_000_000


def far_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned reviews whose customers lie beyond the range of int."""
    rows = reviews(spark, sf_dir).withColumn("customer_id", (F.col("customer_id") + F.lit(FAR_CUSTOMERS)).cast("string"))
    return cut_lineage(cleaning.clean_reviews(rows), "far")


@query(
    "codes_of_two_loads",
    CLEANED_PARTS
    + f""", loads AS (
      SELECT customer_id + {FAR_CUSTOMERS} AS customer_id, CASE WHEN min(review_date) < DATE '1995-06-01' THEN 1 ELSE 2 END AS version
      FROM cleaned GROUP BY customer_id)
    SELECT customer_id, CAST(row_number() OVER (ORDER BY version, customer_id) - 1 AS INT) AS user_code, version FROM loads""",
)
def codes_of_two_loads(spark, sf_dir):
    """Codes after the customers of an early load, then of all reviews, then of all reviews again."""
    rows, path = far_reviews(spark, sf_dir), scratch_path(spark, "codes")
    for load in (rows.filter("review_date < DATE '1995-06-01'"), rows, rows):
        dictionaries.extend_codes(load, path, "customer_id", "user_code")
    return dictionaries.read_codes(spark, path, "customer_id", "user_code")


@query("recommend_far_customers")
def recommend_far_customers(spark, sf_dir):
    """Cleaned, coded, trained and recommended to, with customers beyond the range of int."""
    rows, path = far_reviews(spark, sf_dir), scratch_path(spark, "codes")
    dictionaries.extend_codes(rows, f"{path}/users", "customer_id", "user_code")
    dictionaries.extend_codes(rows, f"{path}/items", "product_id", "item_id")
    users = dictionaries.read_codes(spark, f"{path}/users", "customer_id", "user_code")
    items = dictionaries.read_codes(spark, f"{path}/items", "product_id", "item_id", "string")
    coded = dictionaries.with_codes(dictionaries.with_codes(rows, users, "customer_id", "user_code"), items, "product_id", "item_id")
    model = recommend.train_als(cut_lineage(coded.select("user_code", "item_id", "star_rating"), "ratings"), user="user_code")
    return recommend.recommend_coded(model, rows.select("customer_id").distinct(), TOP_N, users, items, recommend.product_titles(rows))


@query(
    "join_recs_products",
    CLEANED_PARTS
    + MASKED
    + f"""SELECT CAST(count(DISTINCT customer_id) * {TOP_N} AS BIGINT) AS recommendations, CAST(count(DISTINCT customer_id) * {TOP_N} AS BIGINT) AS titled,
      true AS known FROM train""",
)
def join_recs_products(spark, sf_dir):
    """How often products are recommended, over all products with their one title: every recommendation keeps its place."""
    rows, index, _, model = trained(spark, sf_dir)
    titles = cut_lineage(recommend.product_titles(rows), "titles")
    titled = recommend.recommend_all(model, TOP_N, index, titles)
    per_product = titled.groupBy("product_id", "product_title", "product_category").agg(F.count("*").alias("users"))
    found = per_product.join(titles.withColumn("_known", F.lit(True)), ["product_id", "product_title", "product_category"], "left")
    return found.agg(
        F.sum("users").alias("recommendations"),
        F.sum(F.when(F.col("product_title").isNotNull(), F.col("users"))).alias("titled"),
        F.min(F.coalesce("_known", F.lit(False))).alias("known"),
    )


@query(
    "users_without_recs",
    CLEANED_PARTS
    + """, masked AS (SELECT *, rank() OVER (PARTITION BY customer_id ORDER BY product_id DESC) AS place,
                count(*) OVER (PARTITION BY customer_id) AS n FROM cleaned)
    SELECT CAST(c_custkey AS INT) AS customer_id FROM customer WHERE c_custkey NOT IN (
      SELECT customer_id FROM masked WHERE place > CAST(floor(n * 0.3::DOUBLE) AS INT))""",
)
def users_without_recs(spark, sf_dir):
    """Customers a model cannot have factors for: those without training rows. No model is fitted to list them."""
    splits = splitting.split_mask(refined(spark, sf_dir), fraction=splitting.MASK_FRACTION)
    users = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("customer_id"))
    return users.distinct().join(part(splits, "train").select("customer_id"), "customer_id", "left_anti")


@query("model_io", CLEANED_PARTS + MASKED + "SELECT customer_id, product_id, review_id, true AS same FROM scorable")
def model_io(spark, sf_dir):
    """Whether a model that was stored and loaded again gives the scores of the first one, with decoded products."""
    _, index, splits, model = trained(spark, sf_dir, ["review_id"], [])
    path = scratch_path(spark, "model")
    recommend.save_model(model, index, path)
    loaded, items = recommend.load_model(spark, path)
    first = model.transform(part(splits, "test").select("customer_id", "item_id", "review_id")).withColumnRenamed("prediction", "_first")
    # Written, so that the shuffled rows of both models are not on the disks together.
    first = cut_lineage(first, "scored")
    tidy_disks(spark)
    both = loaded.transform(first).withColumn("same", F.abs(F.col("prediction") - F.col("_first")) < 1e-6)
    return recommend.decode_items(both, items).select(F.col("customer_id").cast("bigint"), "product_id", "review_id", "same")


# Text: 2 is good text, 1 poor text, 0 toxic text


def all_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its split; the label is null where there is none."""
    known = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    label = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).when(known, 1).cast("double").alias("label")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return splitting.split_hash(rows.select("doc_id", "text", label), "doc_id", splitting.HOLDOUT_SHARES)


def text_model(spark: SparkSession, sf_dir: str):
    rows = cut_lineage(all_documents(spark, sf_dir))
    return rows, text.train_text(part(rows, "train").filter("label IS NOT NULL"))


@query(
    "text_profile",
    f"""SELECT name AS label, {DESCRIBE} FROM (
      SELECT CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 'neutral' END AS name, length(text) AS n
      FROM documents LEFT JOIN labels USING (doc_id)) GROUP BY name""",
)
def text_profile(spark, sf_dir):
    """Length statistics per label, and of the documents without one."""
    name = fn.decode(F.col("label").cast("int"), fn.LABEL_TO_ID).alias("label")
    rows = all_documents(spark, sf_dir).select(name, F.length("text").alias("text_length"))
    return rounded(profiling.describe(rows, "text_length", ["label"]), "mean", "std", "q1", "median", "q3")


TEXT_WORDS = """word_lists AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^a-zA-Z0-9_]+'), lambda w: length(w) > 0) AS words FROM documents)"""


@query("text_features", f"WITH {TEXT_WORDS} SELECT doc_id, CAST(len(words) AS INT) AS words, CAST(len(list_distinct(words)) AS INT) AS different, true AS plausible FROM word_lists")
def text_features(spark, sf_dir):
    """Words and distinct words of each document; the features are no more than these (two may share a place)."""
    featured = text.text_features(all_documents(spark, sf_dir))
    # The stored entries of the sparse vector; turning it into an array would fill up every place.
    weights = F.filter(F.unwrap_udt("features").getField("values"), lambda w: w > 0)
    different = F.size(F.array_distinct("words"))
    plausible = (F.size(weights) <= different) & ((F.size(weights) > 0) | (different < 30))
    return featured.select("doc_id", F.size("words").alias("words"), different.alias("different"), plausible.alias("plausible"))


LABELS = f"""labelled_docs AS (
  SELECT doc_id, CASE WHEN {hash_sql("doc_id")} < 0.4 THEN 'train' WHEN {hash_sql("doc_id")} < 0.8 THEN 'validation' ELSE 'test' END AS split,
    CAST(CASE WHEN toxic = 1 THEN 0 WHEN quality = 1 THEN 2 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 1 END AS DOUBLE) AS label
  FROM documents LEFT JOIN labels USING (doc_id))"""


def plausible_accuracy(scored: DataFrame, least: float) -> DataFrame:
    return scored.withColumn("plausible", F.col("accuracy").between(least, 1)).drop("accuracy")


@query(
    "text_classifier_train",
    f"WITH {LABELS} SELECT count(*) AS scored, true AS plausible FROM labelled_docs WHERE split = 'train' AND label IS NOT NULL",
)
def text_classifier_train(spark, sf_dir):
    """Rows the classifier was trained on, and whether it gets most of them right."""
    rows, model = text_model(spark, sf_dir)
    scored = text.score_text(model, part(rows, "train").filter("label IS NOT NULL"))
    return plausible_accuracy(metrics.accuracy(scored, "label", "prediction"), 0.6)


@query(
    "text_classifier_score",
    f"""SELECT doc_id, CASE WHEN place < 0.4 THEN 'train' WHEN place < 0.8 THEN 'validation' ELSE 'test' END AS split,
      CAST(CASE WHEN toxic = 1 THEN 0 WHEN quality = 1 THEN 2 WHEN quality IS NOT NULL OR toxic IS NOT NULL THEN 1 END AS DOUBLE) AS label,
      true AS scored
    FROM (SELECT *, {hash_sql("doc_id")} AS place FROM documents LEFT JOIN labels USING (doc_id))""",
)
def text_classifier_score(spark, sf_dir):
    """Every document gets one of the three labels."""
    rows, model = text_model(spark, sf_dir)
    scored = text.score_text(model, rows)
    one_of = (F.col("prediction").isin(0, 1, 2) & F.col("predicted").isNotNull()).alias("scored")
    return scored.select("doc_id", "split", "label", one_of)


def evaluated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, model = text_model(spark, sf_dir)
    scored = text.score_text(model, rows.filter("label IS NOT NULL"))
    return metrics.accuracy(scored, "label", "prediction", ["split"])


@query(
    "text_classifier_eval",
    f"WITH {LABELS} SELECT split, count(*) AS scored, true AS plausible FROM labelled_docs WHERE label IS NOT NULL GROUP BY split",
)
def text_classifier_eval(spark, sf_dir):
    """Labelled documents of each part, and whether more are right than by a guess among three."""
    return plausible_accuracy(evaluated(spark, sf_dir), 0.34)


@query("text_classifier_accuracy")
def text_classifier_accuracy(spark, sf_dir):
    """The accuracy itself."""
    return evaluated(spark, sf_dir)


@query("train_history", "SELECT 0 AS first_round, true AS gapless, true AS falling")
def train_history(spark, sf_dir):
    """The losses of the training rounds: numbered without a gap, and lower at the end than at the start."""
    _, model = text_model(spark, sf_dir)
    rounds = text.train_history(model)
    return rounds.agg(
        F.min("round").alias("first_round"),
        (F.max("round") == F.count("*") - 1).alias("gapless"),
        (F.max_by("loss", "round") < F.min_by("loss", "round")).alias("falling"),
    )


@query("train_losses")
def train_losses(spark, sf_dir):
    _, model = text_model(spark, sf_dir)
    return text.train_history(model)
