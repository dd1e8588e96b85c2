"""Matrix-factorisation recommender on Spark ML: item codes, training, evaluation, top-n tables."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill.operators.metrics import regression_metrics
from reviewmill.operators.numbering import running_total
from reviewmill.session import cut_lineage, remove_path, scratch_path, shared_folder, tidy_disks

ALS_SEED = 42
# Shuffle files go with the next checkpoint, so a training holds those of one round; with few ratings these are small.
CHECKPOINT_ROUNDS, CHECKPOINT_ROUNDS_SMALL, SMALL_RATINGS = 1, 5, 1_000_000
TOP_N = 10
# Blocks of a training at least, ratings of a block, and ratings that the fits of a search hold at a time.
BLOCKS, BLOCK_RATINGS, FIT_RATINGS = 10, 5_000_000, 25_000_000
# Users that a task serves together and groups up to which that holds, items of a block, users that are scored with it
# at a time (their scores stay in the processor's cache), items of the first round and blocks of a round at most.
GROUP_USERS, GROUPS, PIECE_ITEMS, PIECE_USERS, FIRST_ITEMS, MOST_BLOCKS = 20_000, 48, 1024, 256, 4096, 1024
# Few users are dealt to this many groups, if each has enough users that its blocks of items are worth reading.
FEW_GROUPS, FEW_USERS = 24, 512
# Parameter lists of the search.
GRID = {"max_iter": [5, 10, 15], "reg": [0.1, 0.01, 0.001], "rank": [5, 10, 15]}
SMALL_GRID = {"max_iter": [5, 10, 15], "reg": [0.001, 0.01, 0.1], "rank": [1]}


def fit_item_index(df: DataFrame, item: str = "product_id", ranges: int | None = None) -> DataFrame:
    """Dense item codes from 0, most frequent item first, equal counts in alphabetical order.

    The code is the number of items with a higher count plus the position among the items with the
    same count. The first part comes from the histogram of counts (at most about sqrt(2 x rows)
    entries), so no task and no driver ever holds the list of items.
    """
    counts = df.filter(F.col(item).isNotNull()).groupBy(item).agg(F.count("*").alias("item_rows"))
    more_frequent = Window.orderBy(F.col("item_rows").desc()).rowsBetween(Window.unboundedPreceding, -1)
    histogram = counts.groupBy("item_rows").agg(F.count("*").alias("_items"))
    starts = histogram.select("item_rows", F.coalesce(F.sum("_items").over(more_frequent), F.lit(0)).alias("_start"))
    placed = running_total(counts, ["item_rows"], [item], before="_before", total="_total", ranges=ranges)
    code = (F.col("_start") + F.col("_before")).cast("int")
    return placed.join(starts, "item_rows").select(item, code.alias("item_id"), "item_rows")


def encode_items(df: DataFrame, index: DataFrame, item: str = "product_id") -> DataFrame:
    return df.join(index.select(item, "item_id"), item)


def decode_items(df: DataFrame, index: DataFrame, item: str = "product_id") -> DataFrame:
    return df.join(index.select(item, "item_id"), "item_id")


def training_blocks(n_ratings: int) -> int:
    """Blocks of factors for so many ratings."""
    return max(BLOCKS, -(-n_ratings // BLOCK_RATINGS))


def train_als(
    train: DataFrame,
    max_iter: int = 5,
    reg: float = 0.1,
    rank: int = 10,
    seed: int = ALS_SEED,
    user: str = "customer_id",
    item: str = "item_id",
    rating: str = "star_rating",
    blocks: int | None = None,
    folder: str | None = None,
) -> ALSModel:
    """Explicit-feedback factors, non-negative; users or items without training rows get no score.

    The factors are cut into ``blocks``, by default ten and one for each five million ratings at least, as a block's ratings have
    to fit into a task. The model depends on that number and on nothing of the session. Spark writes the factors
    out every round (every five below a million ratings), which bounds what a lost executor costs and the shuffle files of earlier
    rounds, which then go. From a million ratings on or with ``folder`` the model returned reads the factors from there (a new one of
    the shared folder by default): what training kept in memory and on disks goes before anything is scored. Spark's
    trainer takes ids within the range of int; give larger ones codes first (:mod:`reviewmill.operators.dictionaries`).
    """
    spark = train.sparkSession
    shared_folder(spark)
    ratings = train.select(user, item, rating)
    n_ratings = ratings.count()
    blocks = training_blocks(n_ratings) if blocks is None else blocks
    small = n_ratings < SMALL_RATINGS
    als = ALS(
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        userCol=user,
        itemCol=item,
        ratingCol=rating,
        maxIter=max_iter,
        regParam=reg,
        rank=rank,
        seed=seed,
        nonnegative=True,
        checkpointInterval=CHECKPOINT_ROUNDS_SMALL if small else CHECKPOINT_ROUNDS,
        coldStartStrategy="drop",
    )
    if small and folder is None:
        return als.fit(ratings)
    folder = folder or scratch_path(spark, "factors")
    als.fit(ratings).write().save(folder)
    tidy_disks(spark)
    return ALSModel.load(folder)


def score_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """All rows of ``pairs`` with their ``prediction``: null where the model knows the user or the item not."""
    keeping = model.copy().setColdStartStrategy("nan")
    return keeping.transform(pairs).withColumn("prediction", F.when(~F.isnan("prediction"), F.col("prediction")))


def evaluate_als(model: ALSModel, held_out: DataFrame, rating: str = "star_rating", by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, MAPE, scored rows and rows asked for, in one pass over the predictions."""
    return regression_metrics(score_pairs(model, held_out), rating, "prediction", by)


def grid_combinations(grid: dict[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def fits_at_a_time(n_ratings: int, parallelism: int) -> int:
    """Fits of a search that run side by side: each keeps its ratings in memory and on disks, so large ones run one by one."""
    return max(1, min(parallelism, FIT_RATINGS // max(1, n_ratings)))


def grid_search_als(
    train: DataFrame, validation: DataFrame, grid: dict[str, Sequence] | None = None, parallelism: int = 4
) -> DataFrame:
    """One row per parameter combination with its validation errors.

    Both frames should be written or persisted, since each fit reads them. Fits are submitted from
    up to ``parallelism`` threads, fewer for many ratings; only the one-row results come to the driver. What a fit
    wrote is deleted once it is scored.
    """
    spark = train.sparkSession
    combinations = grid_combinations(grid or GRID)
    n_ratings = train.count()

    def score(params: dict) -> tuple:
        folder = scratch_path(spark, "fit") if n_ratings >= SMALL_RATINGS else None
        model = train_als(train, **params, folder=folder)
        row = evaluate_als(model, validation).first()
        del model
        if folder:
            remove_path(spark, folder)
            tidy_disks(spark)
        else:
            spark._jvm.System.gc()
        return (params["max_iter"], float(params["reg"]), params["rank"], row.rmse, row.mae, row.predictions, row.asked)

    with ThreadPoolExecutor(fits_at_a_time(n_ratings, parallelism)) as pool:
        rows = list(pool.map(score, combinations))
    schema = "max_iter int, reg double, rank int, rmse double, mae double, predictions bigint, asked bigint"
    return spark.createDataFrame(rows, schema)


def product_titles(df: DataFrame) -> DataFrame:
    """One row per product. Products sold under several titles keep the alphabetically first."""
    first = F.min(F.struct("product_title", "product_category")).alias("_t")
    return df.groupBy("product_id").agg(first).select("product_id", "_t.*")


def _length(features: Column) -> Column:
    return F.sqrt(F.aggregate(features, F.lit(0.0).cast("double"), lambda total, x: total + x.cast("double") * x.cast("double")))


class _Group:
    """Some users with their best items so far."""

    def __init__(self, n: int):
        self.n, self.parts, self.ready = n, [], False

    def add(self, batch: pa.RecordBatch) -> None:
        self.parts.append(batch)

    def prepare(self) -> None:
        table = pa.Table.from_batches(self.parts).combine_chunks()
        self.users, self.length = table["at"].to_numpy(), table["length"].to_numpy()
        self.scored = table["scored"].to_numpy().copy()
        rank = len(table["features"][0])
        self.rough = table["features"].combine_chunks().flatten().to_numpy().reshape(-1, rank)
        self.features = self.rough.astype(np.float64)
        # Places without an item yet have no id and a score below all.
        self.ids, self.scores = np.full((len(self.users), self.n), np.iinfo(np.int64).max), np.full((len(self.users), self.n), -np.inf)
        sizes = np.asarray(table["ids"].combine_chunks().value_lengths().fill_null(0))
        row = np.repeat(np.arange(len(sizes)), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.ids[row, place] = table["ids"].combine_chunks().flatten().to_numpy()
        self.scores[row, place] = table["scores"].combine_chunks().flatten().to_numpy()
        self.parts, self.ready = [], True

    def score(self, ids: np.ndarray, features: np.ndarray, longest: float) -> None:
        """Take in items of at most the given length, for users whom one of them could still matter to.

        All pairs are scored in single precision. Where that score, with all that rounding may have taken from it,
        reaches the n-th best so far, the pair is scored in double precision, which alone decides.
        """
        # The bound is rounded up a little, as lengths and scores are rounded, too.
        open_users = np.flatnonzero(self.length * longest * (1 + 1e-9) >= self.scores[:, -1])
        self.scored[open_users] += len(ids)
        reach = self.length * longest
        within_single = len(open_users) and reach[open_users].max() < 1e30
        rough, error = (self.rough, 2.0**-23) if within_single else (self.features, 2.0**-52)
        slack = reach * ((features.shape[1] + 4) * error) + 1e-40
        turned = np.ascontiguousarray(features.T.astype(rough.dtype))
        buffer, found = np.empty((PIECE_USERS, len(ids)), dtype=rough.dtype), []
        for low in range(0, len(open_users), PIECE_USERS):
            chosen = open_users[low : low + PIECE_USERS]
            scores = np.matmul(rough[chosen], turned, out=buffer[: len(chosen)])
            least = self.scores[chosen, -1] - slack[chosen]
            empty = np.flatnonzero(least == -np.inf)
            if len(empty) and len(ids) >= self.n:
                least[empty] = -np.partition(-scores[empty], self.n - 1, axis=1)[:, self.n - 1] - 2 * slack[chosen[empty]]
            least = np.nextafter(least.astype(rough.dtype), rough.dtype.type(-np.inf))
            hit = np.flatnonzero(scores.max(axis=1) >= least)
            row, column = np.nonzero(scores[hit] >= least[hit, None])
            found.append((chosen[hit[row]], column))
        if found:
            self._merge(*(np.concatenate(x) for x in zip(*found)), ids, features)

    def _merge(self, user: np.ndarray, item: np.ndarray, ids: np.ndarray, features: np.ndarray) -> None:
        """Put the items into the places of their users; equal scores are ordered by id."""
        scores, named = np.einsum("ij,ij->i", self.features[user], features[item]), ids[item]
        last = self.scores[user, -1]
        better = (scores > last) | ((scores == last) & (named < self.ids[user, -1]))
        user, named, scores = user[better], named[better], scores[better]
        changed = np.unique(user)
        row = np.concatenate([np.repeat(changed, self.n), user])
        named, scores = np.concatenate([self.ids[changed].ravel(), named]), np.concatenate([self.scores[changed].ravel(), scores])
        order = np.lexsort((named, -scores, row))
        row = row[order]
        place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
        kept = place < self.n
        self.ids[row[kept], place[kept]], self.scores[row[kept], place[kept]] = named[order[kept]], scores[order[kept]]

    def rows(self) -> pa.RecordBatch:
        if not self.ready:
            self.prepare()
        found = self.scores > -np.inf
        offsets = pa.array(np.append(0, np.cumsum(found.sum(axis=1))).astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[found])) for x in (self.ids, self.scores)]
        ends = pa.array(np.arange(len(self.users) + 1, dtype=np.int32) * self.features.shape[1])
        columns = [pa.array(self.users), pa.array(self.length), pa.ListArray.from_arrays(ends, pa.array(self.rough.ravel())), *lists, pa.array(self.scored)]
        return pa.record_batch(columns, names=["at", "length", "features", "ids", "scores", "scored"])


def _score_groups(n: int):
    """Groups of users against blocks of items by falling length: rows ``grp, kind, at, length, features, ids, scores, scored``.

    A row of kind 0 is a user with the best items so far, one of kind 1 a block of items: ``ids``, all ``features``
    one after the other, and the ``length`` of the longest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, group = None, _Group(n)
        for batch in batches:
            control = batch.column(0).to_numpy() * 2 + batch.column(1).to_numpy()
            cuts = [0, *(np.flatnonzero(control[1:] != control[:-1]) + 1).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                if low == high:
                    continue
                part, (number, kind) = batch.slice(low, high - low), divmod(int(control[low]), 2)
                if number != current:
                    if group.ready or group.parts:
                        yield group.rows()
                    current, group = number, _Group(n)
                if kind == 0:
                    group.add(part)
                    continue
                # No user of this number is waiting.
                if not (group.ready or group.parts):
                    continue
                if not group.ready:
                    group.prepare()
                for at in range(part.num_rows):
                    block = part.slice(at, 1)
                    ids = block.column("ids").flatten().to_numpy()
                    features = block.column("features").flatten().to_numpy().reshape(len(ids), -1).astype(np.float64)
                    group.score(ids, features, block.column("length")[0].as_py())
        if group.ready or group.parts:
            yield group.rows()

    return run


def _blocks(placed: DataFrame, first_items: int = FIRST_ITEMS) -> DataFrame:
    """Items in blocks by falling length: ``block, items, ids, features, length``.

    A block has ``PIECE_ITEMS``; where ``first_items`` is less, blocks begin with so many and double until then.
    """
    number, start, size, small = None, 0, first_items, 0
    while size < PIECE_ITEMS:
        start, here = start + size, F.lit(small).cast("long")
        number = F.when(F.col("place") < start, here) if number is None else number.when(F.col("place") < start, here)
        size, small = size * 2, small + 1
    full = F.floor((F.col("place") - start) / PIECE_ITEMS) + small
    number = full if number is None else number.otherwise(full)
    items = F.array_sort(F.collect_list(F.struct("place", "item", "length", "features"))).alias("_items")
    blocks = placed.groupBy(number.alias("block")).agg(items)
    return blocks.select(
        "block",
        F.size("_items").alias("items"),
        F.col("_items.item").alias("ids"),
        F.flatten("_items.features").alias("features"),
        F.col("_items")[0]["length"].alias("length"),
    )


def _groups(n_waiting: int, group_users: int) -> int:
    """Groups of users, each of which one task serves.

    Every group is sent all items, so beyond some number of them groups grow instead, up to tenfold; below it few users make
    more groups, as the pairs of one group are scored by one core.
    """
    groups = -(-n_waiting // group_users)
    spread = min(FEW_GROUPS, -(-n_waiting // min(FEW_USERS, group_users)))
    return max(min(groups, GROUPS), spread, -(-groups // 10))


def top_items(users: DataFrame, items: DataFrame, n: int, first_items: int = FIRST_ITEMS, group_users: int = GROUP_USERS) -> DataFrame:
    """The exact ``n`` best items of each user by inner product, without scoring all pairs.

    ``users`` and ``items`` have ``id`` and ``features``. Items are taken by falling length of their factors, in blocks,
    and the blocks in rounds of growing size. A user is done when its own length times that of the next item is below its
    n-th score, as no later item can then reach it; only the others go on to the next round. A task holds
    one group of users and streams the blocks of the round. Equal scores are ordered by item id.

    Returns ``id, recommendations, scored``: structs of item and rating, best first, and the number of items that
    were scored for the user. Users and items without factors have no row.
    """
    state_schema = "at long, length double, features array<float>, ids array<long>, scores array<double>, scored long"
    usable = F.col("id").isNotNull() & F.col("features").isNotNull()
    factors = items.filter(usable).select(F.lit(0).alias("_all"), F.col("id").cast("long").alias("item"), "features")
    factors = factors.withColumn("length", _length(F.col("features"))).withColumn("_shorter", -F.col("length"))
    placed = running_total(factors, ["_all"], ["_shorter", "item"], before="place", total="n_items")
    blocks = cut_lineage(_blocks(placed.select("item", "features", "length", "place"), first_items), "items")
    empty = [F.array().cast("array<long>").alias("ids"), F.array().cast("array<double>").alias("scores"), F.lit(0).cast("long").alias("scored")]
    waiting = users.filter(usable).select(F.col("id").cast("long").alias("at"), _length(F.col("features")).alias("length"), "features", *empty)
    waiting = cut_lineage(waiting, "users")
    done, low, size = [], 0, max(1, first_items // PIECE_ITEMS)
    while True:
        longest = blocks.filter(F.col("block") == low).select("length").first()
        n_waiting = waiting.count() if longest else 0
        if not n_waiting:
            done.append(waiting)
            break
        groups = _groups(n_waiting, group_users)
        here = blocks.filter((F.col("block") >= low) & (F.col("block") < low + size))
        number = F.pmod(F.xxhash64("at"), F.lit(groups)).cast("int").alias("grp")
        asked = waiting.select(number, F.lit(0).alias("kind"), *waiting.columns)
        every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp")
        offered = here.select(every, F.lit(1).alias("kind"), F.col("block").alias("at"), "length", "features", "ids", *empty[1:])
        dealt = asked.union(offered).repartitionById(groups, F.col("grp")).sortWithinPartitions("grp", "kind", "at")
        state = cut_lineage(dealt.mapInArrow(_score_groups(n), state_schema), "best")
        low, size = low + size, min(size * 4, MOST_BLOCKS)
        following = blocks.filter(F.col("block") == low).select("length").first()
        if following is None:
            done.append(state)
            break
        reach = F.col("length") * F.lit(following.length * (1 + 1e-9))
        still = (F.size("ids") < n) | (reach >= F.element_at("scores", n))
        done.append(state.filter(~still))
        waiting = state.filter(still)
    pairs = F.transform(F.arrays_zip("ids", "scores"), lambda p: F.struct(p["ids"].cast("int").alias("item_id"), p["scores"].cast("float").alias("rating")))
    return reduce(DataFrame.union, done).select(F.col("at").alias("id"), pairs.alias("recommendations"), "scored")


def _flatten(recommendations: DataFrame, index: DataFrame, products: DataFrame) -> DataFrame:
    rows = recommendations.select("customer_id", F.inline("recommendations"))
    titled = decode_items(rows, index).join(products, "product_id")
    return titled.select("customer_id", "product_id", "product_title", "product_category", "rating")


def recommend_items(model: ALSModel, users: DataFrame | None, n: int) -> DataFrame:
    """``customer_id, recommendations, scored`` for the given users (all of the model without them)."""
    served = model.userFactors
    if users is not None:
        served = served.join(users.select(F.col("customer_id").alias("id")), "id", "left_semi")
    return top_items(served, model.itemFactors, n).withColumnRenamed("id", "customer_id")


def recommend(model: ALSModel, users: DataFrame, n: int, index: DataFrame, products: DataFrame) -> DataFrame:
    """Top ``n`` items with title and category for the given users, one row per item (:func:`top_items`)."""
    return _flatten(recommend_items(model, users, n), index, products)


def recommend_all(model: ALSModel, n: int, index: DataFrame, products: DataFrame) -> DataFrame:
    """The same for all users of the model."""
    return _flatten(recommend_items(model, None, n), index, products)


def recommend_coded(
    model: ALSModel, users: DataFrame, n: int, user_codes: DataFrame, item_codes: DataFrame, products: DataFrame
) -> DataFrame:
    """The same for a model of user codes: customers of any 64-bit id, back as they came."""
    coded = users.join(user_codes, "customer_id").select("customer_id", "user_code")
    found = recommend_items(model, coded.select(F.col("user_code").alias("customer_id")), n).withColumnRenamed("customer_id", "user_code")
    named = found.join(user_codes.select("customer_id", "user_code"), "user_code")
    return _flatten(named, item_codes, products)


def users_without_recommendations(users: DataFrame, model: ALSModel) -> DataFrame:
    """Users the model has no factors for, hence nothing to recommend; no scoring is needed to tell."""
    known = model.userFactors.select(F.col("id").alias("customer_id"))
    return users.select("customer_id").distinct().join(known, "customer_id", "left_anti")


def save_model(model: ALSModel, index: DataFrame, path: str) -> None:
    """Store the factors and the item codes side by side."""
    model.write().overwrite().save(f"{path}/factors")
    index.write.mode("overwrite").parquet(f"{path}/items")


def load_model(spark: SparkSession, path: str) -> tuple[ALSModel, DataFrame]:
    return ALSModel.load(f"{path}/factors"), spark.read.parquet(f"{path}/items")


def distinct_users(df: DataFrame, users: Iterable[int] | None = None) -> DataFrame:
    chosen = df.select("customer_id").distinct()
    return chosen if users is None else chosen.filter(F.col("customer_id").isin(list(users)))
