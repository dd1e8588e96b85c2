"""Cases in which an operator did less than the whole job."""

from __future__ import annotations

import random

import numpy as np
import pytest
from edge import documents, prose
from pyspark.sql import functions as F

from reviewmill.llm import decontaminate, language_model, near_dup, pseudonyms

# 6


def test_long_passage_with_spread_insertions(spark):
    draw = random.Random(6)
    letters = "".join(draw.choices("abcdefghijklmnop", k=6000))
    changed = "".join(c + ("z" if i % 13 == 12 and i < 13 * 450 else "") for i, c in enumerate(letters))
    docs = documents(spark, [(shift, prose(3, 90)[:shift] + " " + changed + " " + prose(4, 50)) for shift in (0, 150, 300, 450, 600)])
    bench = spark.createDataFrame([(1, letters), (2, prose(5, 20))], "item_id long, text string")
    found = decontaminate.find_passages(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in found) == [(shift, 1, 450) for shift in (0, 150, 300, 450, 600)]


# 8


def test_a_member_just_below_the_leader_keeps_its_link_to_another_member(spark):
    """Texts with one edit are like the base; one with three more is like that member only, in the crowded bucket of the base."""
    base, rows, draw = prose(21, 200).split(" "), [(0, prose(21, 200))], random.Random(8)
    for i in range(120):
        places = draw.sample(range(5, 195, 6), 4)
        for extra in (0, 1):
            text = list(base)
            for p in places[: 1 + 3 * extra]:
                text[p] = f"edit{i}at{p}"
            rows.append((2 * i + 1 + extra, " ".join(text)))
    found = {r.doc_id: r.class_id for r in near_dup.near_duplicates(documents(spark, rows)).collect()}
    assert {i for i, c in found.items() if c != 0} == set()


def test_long_lists_are_compared_in_cells_without_losing_a_pair(spark):
    lists = [(i, 100.0, 95.0 if i % 3 else 85.0, key, i % 2, n) for key, n in ((1, 700), (2, 20)) for i in range(n)]
    frame = spark.createDataFrame(lists, "rep long, weight double, rest double, key long, component long, n long")
    near = [i for i in range(700) if i % 3]
    expected = sum(1 for i in near for j in near if i < j and i % 2 != j % 2)
    pairs = near_dup._pairs_of_lists(frame, 0.8)
    assert pairs.count() == expected
    assert pairs.agg(F.min(F.col("b") - F.col("a"))).first()[0] == 1


def test_entries_of_long_lists_are_sent_a_few_times_only(spark):
    """A list of 9000 entries made 36 rows of each when its slices had 256."""
    entries = spark.range(9000).select(F.col("id").alias("rep"), *[F.lit(x).alias(c) for c, x in (("weight", 1.0), ("rest", 1.0), ("key", 7), ("component", 1), ("n", 9000))])
    cells = near_dup._cells(entries)
    assert cells.count() <= 3 * 9000
    wanted = cells.filter("rep < 60").select("rep", "x", "y")
    met = wanted.alias("l").join(wanted.alias("r"), ["x", "y"]).filter("l.rep < r.rep").select("l.rep", "r.rep").distinct()
    assert met.count() == 60 * 59 // 2


def test_entries_without_a_partner_leave_a_list_and_no_pair_does(spark):
    draw = random.Random(9)
    rows = []
    for i in range(240):
        weight = draw.uniform(80, 130)
        rows.append((i, weight, weight * draw.uniform(0.8, 1.0), i % 3, i % 7))
    # Nobody in this list has enough left.
    rows += [(1000 + i, 100.0, 85.0, 9, i) for i in range(40)]
    lists = spark.createDataFrame(rows, "rep long, weight double, rest double, key long, component long")
    compared = near_dup._compared(lists, 0.8)
    assert compared.filter("key = 9").count() == 0 and compared.count() < 240
    expected = {
        (a[0], b[0]) for a in rows for b in rows
        if a[0] < b[0] and a[3] == b[3] and a[4] != b[4] and min(a[2], b[2]) >= (a[1] + b[1]) * 0.8 / 1.8 * (1 - near_dup.ROUNDING)
    }
    assert {tuple(r) for r in near_dup._pairs_of_lists(compared, 0.8).collect()} == expected and len(expected) > 100


# 9


@pytest.mark.parametrize("value", ["DE89 3704 0044 0532 0130 00", "AT61 1904 3002 3457 3201", "+44 20 7946 0958", "+49 30 123456", "+44 (0)20 7946 0958", "3782 822463 10005", "3782-822463-10005"])
def test_grouped_values_are_replaced_whole(value):
    new, n = pseudonyms.Pseudonyms(b"secret" * 4).replace(f"see {value} BANK on 2024-02-29")
    first = new[4 : 4 + len(value)]
    assert n == 2 and len(new) == len(value) + 23 and new[4 + len(value) :].startswith(" BANK on ") and "2024-02-29" not in new
    assert first != value and [c.isdigit() for c in first] == [c.isdigit() for c in value]
    plain = first.replace(" ", "").replace("-", "")
    if value[0].isalpha():
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    if value[0] == "3":
        assert pseudonyms.luhn(plain[:-1]) == int(plain[-1])
    if value[0] == "+":
        assert first[:3] == value[:3]


def test_groups_that_are_no_account_are_looked_at_again():
    new, n = pseudonyms.Pseudonyms(b"secret" * 4).replace("AB12 4111 1111 1111 1111")
    assert n == 1 and new[:5] == "AB12 " and new[5:] != "4111 1111 1111 1111"


def test_date_after_a_number_abroad_stays_a_date():
    new, n = pseudonyms.Pseudonyms(b"secret" * 4).replace("+49 30 123456 2024-02-29")
    assert n == 2 and pseudonyms.PATTERN.search(new[14:]).lastgroup == "date"


# 10


def test_pair_of_one_training_text_in_a_held_out_text_of_another_chunk(spark):
    rows = [(i, prose(i, 40), False) for i in range(60)]
    rows += [(100, prose(100, 300) + " rareone raretwo rarethree", False), (101, prose(101, 300) + " rareone raretwo rarethree", True)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")

    def score(chunk_tokens, parts):
        settings = language_model.Settings(chunk_tokens=chunk_tokens, shard_ngrams=500)
        return {r.doc_id: r.score for r in language_model.score_corpus(frame.coalesce(1).repartition(parts), settings).collect()}

    whole, cut = score(1 << 20, 1), score(100, 4)
    assert cut == {i: pytest.approx(s, rel=0.003) for i, s in whole.items()}


@pytest.mark.parametrize("highest", [1, 1000, 1 << 40, (1 << 62) + 5])
@pytest.mark.parametrize("n", [0, 1, 5000])
def test_distinct_numbers_and_order_of_keys(n, highest):
    draw = np.random.default_rng(n)
    codes = draw.choice(draw.integers(0, highest, 700), n)
    for one, two in zip(language_model._distinct(codes), np.unique(codes, return_index=True, return_inverse=True), strict=True):
        assert one.tolist() == two.tolist()
    for shards in (1, 40, 100_000):
        row = {"words": b"", "ids": b"", "sizes": [], "held": []}
        chunk = language_model.Chunk(row, language_model.Settings(), shards, (0, 0))
        keys = codes.astype(np.uint64)
        shard, order = chunk._order(keys, keys)
        assert order.tolist() == np.lexsort((keys, shard)).tolist()
