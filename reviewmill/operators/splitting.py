"""Train, validation and test splits; each returns one frame with a ``split`` column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.numbering import join_null_safe, numbered, ranked, running_total, top_per_key
from reviewmill.operators.sampling import SEED, hash_split
from reviewmill.session import cut_lineage

MASK_FRACTION = 0.3
RANDOM_SHARES = {"train": 0.8, "test": 0.2}
# A fifth for the test, the rest halved.
HOLDOUT_SHARES = {"train": 0.4, "validation": 0.4, "test": 0.2}


def split_hash(df: DataFrame, key: str, shares: Mapping[str, float], seed: int = SEED) -> DataFrame:
    """Random split by a seeded hash of ``key``: repeatable, and no shuffle."""
    return df.withColumn("split", hash_split(F.col(key), shares, seed))


def split_mask(
    df: DataFrame,
    user: str = "customer_id",
    item: str = "product_id",
    fraction: float = 0.2,
    ties: str = "rank",
    row_id: str = "review_id",
    ranges: int | None = None,
    rest: str = "train",
    masked: str = "test",
) -> DataFrame:
    """Per user, mask trunc(rows x fraction) of the items that come last in the alphabet.

    With ``ties="rank"`` all rows of an item share a rank, so the masked part can only be larger than
    the target; ``ties="row_number"`` tells them apart by ``row_id`` and hits the target.
    """
    if ties == "rank":
        placed = ranked(df, [user], item, True, "product_rank", "number_of_products", ranges)
    elif ties == "row_number":
        placed = numbered(df, [user], [item, row_id], True, "product_rank", ranges, "number_of_products")
    else:
        raise ValueError(f"unknown ties {ties!r}")
    to_mask = (F.col("number_of_products") * F.lit(fraction)).cast("int")
    label = F.when(F.col("product_rank") <= F.col("number_of_products_to_mask"), F.lit(masked)).otherwise(F.lit(rest))
    return placed.withColumn("number_of_products_to_mask", to_mask).withColumn("split", label)


def split_mask_nested(
    df: DataFrame,
    user: str = "customer_id",
    item: str = "product_id",
    fraction: float = MASK_FRACTION,
    ranges: int | None = None,
) -> DataFrame:
    """Mask twice: the test part first, then the validation part from what is left.

    All rows of a user's item share their part, so both masks are laid over user, item and number of rows; the rows
    themselves are joined with the outcome once.
    """
    counts = df.groupBy(user, item).agg(F.count("*").alias("_n"))
    first = cut_lineage(_masked_values(counts, user, item, fraction, ranges, "test"), "masked")
    rest = first.filter(F.col("split") == "train").select(user, item, "_n")
    second = _masked_values(rest, user, item, fraction, ranges, "validation")
    parts = second.unionByName(first.filter(F.col("split") == "test")).drop("_n")
    return join_null_safe(df, parts, [user, item]).select(*df.columns, "split")


def _masked_values(counts: DataFrame, user: str, item: str, fraction: float, ranges: int | None, masked: str) -> DataFrame:
    """``counts(user, item, _n)`` with the part that the items fall into, by the rank that their rows share."""
    placed = running_total(counts, [user], [item], F.col("_n"), True, "_before", "_total", ranges)
    to_mask = (F.col("_total") * F.lit(fraction)).cast("int")
    label = F.when(F.col("_before") + 1 <= to_mask, F.lit(masked)).otherwise(F.lit("train"))
    return placed.select(user, item, "_n", label.alias("split"))


def split_leave_last(
    df: DataFrame,
    user: str = "customer_id",
    order: Sequence[str] = ("review_date", "review_id"),
) -> DataFrame:
    """Per user the latest row is the test, the one before it the validation, the rest training.

    Only the two latest rows per user matter: they are found with a limit that applies before the
    shuffle, then every row is compared with them. ``order`` must tell the rows of a user apart.
    """
    place = F.struct(*order)
    latest = top_per_key(df.select(user, *order), [user], [F.col(c).desc() for c in order], 2)
    marks = latest.groupBy(user).agg(
        F.max(F.when(F.col("position") == 1, place)).alias("_last"),
        F.max(F.when(F.col("position") == 2, place)).alias("_second"),
    )
    label = (
        F.when(place == F.col("_last"), F.lit("test"))
        .when(place == F.col("_second"), F.lit("validation"))
        .otherwise(F.lit("train"))
    )
    return join_null_safe(df, marks, [user]).withColumn("split", label).drop("_last", "_second")


def split_counts(splits: DataFrame, by: Sequence[str] = ("split",)) -> DataFrame:
    return splits.groupBy(*by).agg(F.count("*").alias("rows"))
