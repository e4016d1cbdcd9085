"""Delayed histories and as-of joins against literal loops, on ordinary and on hot keys."""

from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta

import pytest

from tidemark.operators.asof import asof_join
from tidemark.operators.history import delayed_history
from tidemark.operators.hotkeys import HotKeys

START = datetime(2024, 1, 1, tzinfo=UTC)
GAP = timedelta(hours=1)
SCHEMA = "row_id INT, member STRING, item INT, label INT, at TIMESTAMP"


def literal_history(rows, limit=32):
    """Append, and once past twice the limit drop the oldest ``limit``."""
    out = {}
    for member in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == member), key=lambda r: (r[4], r[0]))
        for target in mine:
            histories = {True: [], False: []}
            for r in mine:
                if r[4] + GAP <= target[4]:
                    h = histories[r[3] > 0]
                    h.append(r[2])
                    if len(h) > 2 * limit:
                        del h[:limit]
            out[target[0]] = (histories[True], histories[False])
    return out


def make(n, seed=3, members=4, step=180):
    rnd = random.Random(seed)
    return [
        (
            i,
            "hot" if i % 3 == 0 else f"m{rnd.randrange(members)}",
            rnd.randrange(1000),
            int(rnd.random() < 0.4),
            START + timedelta(seconds=step * rnd.randrange(n)),
        )
        for i in range(n)
    ]


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    out = delayed_history(df, member="member", item="item", label="label", time="at", row_id="row_id", **options)
    return {r["row_id"]: (r["positives_history"], r["negatives_history"]) for r in out.collect()}


@pytest.mark.parametrize("rows_per_block", [10**6, 300, 40, 3])
def test_equals_the_literal_loop(spark, rows_per_block):
    rows = make(700)
    assert run(spark, rows, policy=HotKeys(rows_per_block=rows_per_block)) == literal_history(rows)


def test_other_sizes(spark):
    rows = make(300, seed=5)
    assert run(spark, rows, max_size=3, policy=HotKeys(rows_per_block=20)) == literal_history(rows, limit=3)


@pytest.mark.parametrize("mode, lengths", [("sawtooth", [64, 33, 64, 33]), ("last_k", [32, 32, 32, 32])])
def test_lengths_after_64_65_96_97_items(spark, mode, lengths):
    rows = [(i, "m", i, 1, START + timedelta(seconds=i)) for i in range(97)]
    late = [(1000 + n, "m", 0, 0, rows[n - 1][4] + GAP) for n in (64, 65, 96, 97)]
    got = run(spark, rows + late, mode=mode)
    assert [len(got[r[0]][0]) for r in late] == lengths
    assert got[late[-1][0]][0][-1] == 96


def test_an_hour_old_is_visible_and_a_younger_one_is_not(spark):
    rows = [(0, "m", 7, 1, START), (1, "m", 8, 1, START + GAP - timedelta(minutes=1)), (2, "m", 9, 1, START + GAP)]
    got = run(spark, rows)
    assert got[1] == ([], [])
    assert got[2] == ([7], [])


def test_start_keeps_earlier_items(spark):
    rows = make(200, seed=8)
    start = START + timedelta(hours=5)
    got = run(spark, rows, start=start)
    want = literal_history(rows)
    assert got == {r[0]: want[r[0]] for r in rows if r[4] >= start}


@pytest.mark.parametrize("rows_per_block", [10**6, 20, 2])
@pytest.mark.parametrize("tolerance", [None, timedelta(hours=2)])
def test_asof(spark, rows_per_block, tolerance):
    rows = make(400, seed=11)
    left, right = rows[::2], rows[1::2]
    a = spark.createDataFrame(left, SCHEMA).selectExpr("row_id", "member", "at")
    b = spark.createDataFrame(right, SCHEMA).selectExpr("row_id AS seen_id", "member", "item", "at")
    out = asof_join(
        a, b, by=["member"], left_time="at", right_time="at", columns=["seen_id", "item"], right_id="seen_id",
        gap=GAP, tolerance=tolerance, policy=HotKeys(rows_per_block=rows_per_block),
    )
    got = {r["row_id"]: r["seen_id"] for r in out.collect()}
    for row in left:
        seen = [r for r in right if r[1] == row[1] and r[4] + GAP <= row[4]]
        if tolerance is not None:
            seen = [r for r in seen if r[4] + GAP + tolerance >= row[4]]
        best = max(seen, key=lambda r: (r[4], r[0]), default=None)
        assert got[row[0]] == (best and best[0])
