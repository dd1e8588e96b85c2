"""Column expressions used by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentiment names and their ids.
SENTIMENTS = ("negative", "neutral", "positive")
LABEL_TO_ID = {"negative": 0, "neutral": 1, "positive": 2}
# Cut-offs and lengths.
NEGATIVE_MAX_RATING = 2
NEUTRAL_RATING = 3
TEXT_LIMIT = 450
# Smallest denominator of the percentage error (machine epsilon of a double).
MAPE_FLOOR = 2.220446049250313e-16


def sentiment_label(rating: Column) -> Column:
    """negative up to 2, neutral at 3, positive above; a null rating has no label."""
    return (
        F.when(rating <= NEGATIVE_MAX_RATING, F.lit("negative"))
        .when(rating == NEUTRAL_RATING, F.lit("neutral"))
        .when(rating.isNotNull(), F.lit("positive"))
    )


def is_true(text: Column) -> Column:
    """Text as a boolean (Y, yes, true, 1 ...); text that is no boolean counts as not true."""
    return F.coalesce(text.try_cast("boolean"), F.lit(False))


def encode(value: Column, mapping: Mapping) -> Column:
    """Look ``value`` up in a small literal map; absent keys give null."""
    entries = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.try_element_at(F.create_map(*entries), value)


def decode(value: Column, mapping: Mapping) -> Column:
    """Inverse of :func:`encode`."""
    return encode(value, {number: name for name, number in mapping.items()})


def to_day(text: Column) -> Column:
    """Text, date or timestamp as a date; null where it cannot be parsed."""
    return text.try_cast("date")


def truncate_text(text: Column, limit: int = TEXT_LIMIT) -> Column:
    return F.substring(text, 1, limit)


def any_null(columns: Sequence[str | Column]) -> Column:
    tests = [(F.col(c) if isinstance(c, str) else c).isNull() for c in columns]
    return reduce(lambda left, right: left | right, tests)


def all_present(columns: Sequence[str | Column]) -> Column:
    return ~any_null(columns)


def percent_text(share: Column) -> Column:
    return F.format_string("%.2f%%", share * 100)


def safe_ln(value: Column) -> Column:
    """Natural logarithm; null where undefined."""
    return F.when(value > 0, F.ln(value))


def safe_sqrt(value: Column) -> Column:
    """Square root; null where undefined."""
    return F.when(value >= 0, F.sqrt(value))


def argmax_index(scores: Column) -> Column:
    """Zero-based position of the (first) largest entry."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def unit_hash(value: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the value and the seed only.

    Taken from the first 32 bits of an md5 digest, so other engines reproduce it and a recomputed
    task selects the same rows.
    """
    digest = F.md5(F.concat(value.cast("string"), F.lit(f"#{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


HASH_BITS = 60


def order_hash(value: Column, seed: int) -> Column:
    """A whole number of 60 bits that depends on the value and the seed only: a random order of the values."""
    digest = F.md5(F.concat(value.cast("string"), F.lit(f"#{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def vector_sum(values: Column) -> Column:
    """Sum of an array of doubles."""
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)
