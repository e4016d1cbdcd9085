"""Rank counts and yields on hand-made cases."""

from __future__ import annotations

import json

import pytest

from tidemark.operators import describe as D
from tidemark.operators import ranks


def counts(spark, *rows):
    return spark.createDataFrame(rows, "cg_name STRING, cg_rank INT, cnt BIGINT")


def test_sources_missing_on_one_side_stay_in_the_overall_yield(spark):
    pool = ranks.per_rank(counts(spark, ("a", 0, 4), ("a", 1, 4), ("b", 0, 2)))
    front = ranks.per_rank(counts(spark, ("a", 0, 2), ("c", 0, 6)))
    got = {r["cg_name"]: r.asDict() for r in ranks.overall_yield(pool, front).collect()}
    assert got["a"]["front_event_per_cg_slot"] == 0.25
    assert got["a"]["front_event_per_cg_slot_normalized"] == 1.0
    assert got["b"]["cg_pool_share"] == 0.2
    assert got["b"]["front_events_share"] is None
    assert got["c"]["front_events_share"] == 0.75
    assert {r["cg_name"] for r in ranks.yield_summary(pool, front).collect()} == {"a"}


def test_curve(spark):
    pool = ranks.per_rank(counts(spark, ("a", 0, 4), ("a", 1, 2), ("a", 1, 2), ("a", 2, 8)))
    front = ranks.per_rank(counts(spark, ("a", 0, 2), ("a", 2, 2)))
    got = [r.asDict() for r in ranks.yield_curve(pool, front).orderBy("cg_rank").collect()]
    assert [r["cg_pool_cumsum"] for r in got] == [4, 16]
    assert [r["front_events_cumsum"] for r in got] == [2, 4]
    assert [r["front_event_per_cg_slot_normalized"] for r in got] == [1.0, 0.5]
    assert [r["cg_pool_cumshare"] for r in got] == [pytest.approx(4 / 12), pytest.approx(16 / 12)]
    assert [r["front_events_share"] for r in got] == [pytest.approx(2 / 6), pytest.approx(4 / 6)]


def test_source_stats(spark):
    rows = spark.createDataFrame([("a", 0, 3), ("a", 1, 1), ("a", 0, 1), ("b", 4, 5)], "cg_rank STRING, pos INT, cnt BIGINT")
    got = {r["cg_rank"]: r.asDict() for r in ranks.source_stats(rows).collect()}
    assert got["a"]["max_cumsum_ratio"] == 4.0
    assert got["a"]["last_cumsum_ratio"] == 2.5
    assert got["b"]["last_cumsum_ratio"] == 1.0
    assert got["b"]["normalized_cumsum_ratio"] == pytest.approx(0.1)


def test_malformed_lines_raise(spark):
    line = {"cnt": "1", "cg_ranks": '{"s": "3"}', **dict.fromkeys(
        ["isLiked", "isShared", "isProfileOpened", "isDownloaded", "isFollowed"], "true"), "vplay98": True}
    good = spark.createDataFrame([(json.dumps(line),)], "value STRING")
    assert ranks.client_event_ranks(good).first()["cnt"] == 1
    for change in ({"cnt": "one"}, {"isLiked": "yes"}, {"cg_ranks": '{"s": "third"}'}, {"cg_ranks": "{"}):
        bad = spark.createDataFrame([(json.dumps({**line, **change}),)], "value STRING")
        with pytest.raises(Exception):
            ranks.client_event_ranks(bad).collect()


def test_excluded_sources(spark):
    rows = counts(spark, ("promoted", 0, 1), ("sharecone-weighted-Hindi-x", 0, 1), (None, 0, 1))
    got = [r["cg_name"] for r in ranks.without_slots(rows, "cg_name", ["promoted"]).collect()]
    assert got == ["sharecone-weighted-x", None]


def test_argmax_counts_null_as_default(spark):
    rows = spark.createDataFrame([(1, "Alice", None), (2, "Bob", 29.0), (3, "Eve", -1.0)], "id INT, name STRING, age DOUBLE")
    assert D.argmax_row(rows, "age", 0.0, "id").first()["name"] == "Bob"
    assert D.argmax_row(rows.where("id <> 2"), "age", 0.0, "id").first()["name"] == "Alice"


def test_equal_histogram_of_one_value(spark):
    rows = spark.createDataFrame([(5.0,), (5.0,)], "x DOUBLE")
    assert [tuple(r) for r in D.histogram_equal(rows, "x").collect()] == [(1, 2)]


def test_fixed_histogram_bins_cover_negatives(spark):
    rows = spark.createDataFrame([(-0.5,), (0.5,), (10.0,), (None,)], "x DOUBLE")
    got = {r["bin"]: r["count"] for r in D.histogram_fixed(rows, "x", 10.0).collect()}
    assert got == {-10.0: 1, 0.0: 1, 10.0: 1}


def test_missing_counts_as_nonzero(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (None,), (0.0,)], "x DOUBLE")
    assert D.coverage(rows, {"s": ("x <> 0", "true")}).first()["s"] == 0.5


def test_rank_pair_is_two_groupings(spark):
    rows = spark.createDataFrame(
        [("a", 0, 4, True), ("a", 0, 2, False), ("a", 1, 5, None), ("b", 0, 7, True), (None, 2, None, True)],
        "cg_name string, cg_rank int, cnt long, front boolean",
    )
    pool, front = ranks.per_rank_pair(rows, "front")
    for pair, plain in ((pool, ranks.per_rank(rows)), (front, ranks.per_rank(rows.where("front")))):
        assert pair.columns == plain.columns
        assert sorted(pair.collect(), key=str) == sorted(plain.collect(), key=str)
