"""Stratified and per-entity samples; all are pure functions of the data and a seed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.columns import HASH_BITS, encode, order_hash, unit_hash
from reviewmill.operators.numbering import join_null_safe, numbered
from reviewmill.session import cut_lineage

SEED = 42
# Sample sizes in use.
CUSTOMER_FRACTION = 0.1
CUSTOMER_CAP = 500
# Bits of a hash that are counted at a time when a sample of exact size is drawn.
DIGIT_BITS = 15


def stratum_weights(df: DataFrame, key: str, n: int, allocation: str = "proportional") -> DataFrame:
    """Sampling fraction per stratum for a sample of about ``n`` rows.

    ``proportional`` gives every stratum the same fraction n / rows; ``equal`` aims at the same
    number of rows from each stratum.
    """
    # Written, as the totals read it again.
    counts = cut_lineage(df.groupBy(key).agg(F.count("*").alias("count")), "strata")
    rows = counts.agg(F.sum("count")).scalar()
    proportion = F.col("count") / rows
    counts = counts.withColumn("proportion", proportion)
    if allocation == "equal":
        target = F.lit(float(n)) / counts.agg(F.count("*")).scalar()
    elif allocation == "proportional":
        target = F.col("proportion") * n
    else:
        raise ValueError(f"unknown allocation {allocation!r}")
    return counts.withColumn("weight", target / F.col("count"))


def sample_by(df: DataFrame, key: str, fractions: Mapping[str, float], row_id: str, seed: int = SEED) -> DataFrame:
    """Bernoulli sample with a literal fraction per stratum; a stratum not named yields no row."""
    return df.filter(unit_hash(F.col(row_id), seed) < F.coalesce(encode(F.col(key), fractions), F.lit(0.0)))


def sample_by_weights(df: DataFrame, key: str, weights: DataFrame, row_id: str, seed: int = SEED) -> DataFrame:
    """The same with the fractions in a table ``(key, weight)``, e.g. from :func:`stratum_weights`.

    Rows that not even the largest fraction takes are left out before the join, so only about as many rows
    are moved as are drawn.
    """
    place = unit_hash(F.col(row_id), seed)
    return (
        df.filter(place < weights.agg(F.max("weight")).scalar())
        .join(weights.select(key, "weight"), key)
        .filter(place < F.col("weight"))
        .drop("weight")
    )


def stratum_sizes(df: DataFrame, key: str, n: int, allocation: str = "proportional") -> DataFrame:
    """Rows to draw per stratum as whole numbers that add up to ``n``: ``(key, size)``.

    Fractions left over by rounding down go to the strata with the largest ones, ties to the first by name. A
    stratum never gives more rows than it has, so the sum may be smaller. Works on one row per stratum.
    """
    weights = stratum_weights(df, key, n, allocation)
    wanted = weights.withColumn("_want", F.col("weight") * F.col("count")).withColumn("_down", F.floor(F.round("_want", 6)))
    everything = Window.partitionBy(F.lit(0))
    left = n - F.sum("_down").over(everything)
    place = F.row_number().over(everything.orderBy((F.col("_want") - F.col("_down")).desc(), key))
    size = F.col("_down") + F.when(place <= left, 1).otherwise(0)
    return wanted.select(key, F.least("count", size).cast("bigint").alias("size"))


def hash_limits(df: DataFrame, key: str, sizes: DataFrame, row_id: str, seed: int = SEED) -> DataFrame:
    """Per stratum the hash of the last row of its sample: ``(key, last, taken)``.

    The sample has all rows of a smaller hash and ``taken`` rows of just this one. The hash is found digit by
    digit: rows are counted by the next 15 bits of their hash, among those that agree with the digits found, so a
    stratum of any size is a few thousand counts and is never sorted or gathered. Strata with no more rows
    than asked for are taken whole.
    """
    hashes = cut_lineage(df.select(key, order_hash(F.col(row_id), seed).alias("_h")), "hashes")
    found = sizes.filter(F.col("size") > 0).select(key, F.col("size").alias("_left"), F.lit(0).cast("bigint").alias("_prefix"))
    upto = Window.partitionBy(key).orderBy("_digit")
    for shift in range(HASH_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        agree = join_null_safe(hashes, found, [key]).filter(F.shiftright("_h", shift + DIGIT_BITS) == F.col("_prefix"))
        digit = F.shiftright("_h", shift).bitwiseAND((1 << DIGIT_BITS) - 1)
        counts = agree.groupBy(key, "_left", "_prefix", digit.alias("_digit")).agg(F.count("*").alias("_n"))
        running = counts.withColumn("_upto", F.sum("_n").over(upto)).withColumn("_last", F.lead("_digit").over(upto).isNull())
        # The digit at which the rows suffice, or the last one of a stratum that has too few.
        hit = ((F.col("_upto") >= F.col("_left")) & (F.col("_upto") - F.col("_n") < F.col("_left"))) | (F.col("_last") & (F.col("_upto") < F.col("_left")))
        found = running.filter(hit).select(
            key, (F.col("_left") - F.col("_upto") + F.col("_n")).alias("_left"), (F.shiftleft("_prefix", DIGIT_BITS) + F.col("_digit")).alias("_prefix")
        )
        found = cut_lineage(found, "digits")
    return found.select(key, F.col("_prefix").alias("last"), F.col("_left").alias("taken"))


def sample_exact(df: DataFrame, key: str, sizes: DataFrame, row_id: str, seed: int = SEED) -> DataFrame:
    """A random sample of exactly ``size`` rows of each stratum in ``sizes(key, size)``; all rows where there are fewer.

    The rows with the smallest hashes of ``row_id`` are drawn, so the sample is a function of the data and the
    seed, and a smaller sample is a part of a larger one. Rows that share an id share their hash; as many
    of them as are needed are taken.
    """
    sizes = cut_lineage(sizes.select(key, "size"), "sizes")
    limits = hash_limits(df, key, sizes, row_id, seed).withColumnsRenamed({"last": "_last_hash", "taken": "_taken"})
    marked = join_null_safe(df.withColumn("_h", order_hash(F.col(row_id), seed)), limits, [key])
    # Little more than the sample, and written, so that all rows are gone through once for it.
    chosen = cut_lineage(marked.filter(F.col("_h") <= F.col("_last_hash")), "chosen")
    below = chosen.filter(F.col("_h") < F.col("_last_hash"))
    at = numbered(chosen.filter(F.col("_h") == F.col("_last_hash")), [key], [row_id], name="_place").filter(F.col("_place") <= F.col("_taken"))
    return below.select(*df.columns).union(at.select(*df.columns))


def sample_rows(df: DataFrame, row_id: str, fraction: float, seed: int = SEED) -> DataFrame:
    """Uniform sample; no shuffle."""
    return df.filter(unit_hash(F.col(row_id), seed) < fraction)


def sample_entities(
    df: DataFrame, key: str, fraction: float = CUSTOMER_FRACTION, seed: int = SEED, cap: int | None = None
) -> DataFrame:
    """All rows of a share of the keys, at most ``cap`` keys.

    Without a cap the hash of the key decides row by row and nothing is shuffled. With a cap the keys
    with the lowest hashes are taken, and the few ids are joined back.
    """
    chosen = df.filter(unit_hash(F.col(key), seed) < fraction)
    if cap is None:
        return chosen
    return chosen.join(limit_ids(chosen, key, cap, seed), key, "left_semi")


def limit_ids(df: DataFrame, key: str, cap: int = CUSTOMER_CAP, seed: int = SEED) -> DataFrame:
    """At most ``cap`` distinct keys, chosen by hash (ties by the key itself)."""
    return df.select(key).distinct().orderBy(unit_hash(F.col(key), seed), key).limit(cap)


def hash_split(key: Column, shares: Mapping[str, float], seed: int = SEED) -> Column:
    """Name of the part a row falls into, for shares that add up to one."""
    place, upto, label = unit_hash(key, seed), 0.0, None
    names = list(shares)
    for name in names[:-1]:
        upto += shares[name]
        test = place < round(upto, 12)
        label = F.when(test, F.lit(name)) if label is None else label.when(test, F.lit(name))
    return F.lit(names[-1]) if label is None else label.otherwise(F.lit(names[-1]))
