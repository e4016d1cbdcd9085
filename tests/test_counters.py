"""Decayed counters against the literal recursion, on ordinary and on heavily skewed keys."""

from __future__ import annotations

import math
import random
from datetime import UTC, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.counters import Counter, decayed_counters, feature_name, livestream_counters
from tidemark.operators.hotkeys import HotKeys, split_hot_keys

START = datetime(2024, 1, 1, tzinfo=UTC)
TAU = timedelta(days=30)
GAPS = [timedelta(minutes=1), timedelta(hours=1)]
COUNTERS = [Counter("amount", "pay", "x", TAU), Counter("visits", "visit", "1.0", TAU)]
SCHEMA = "event_id INT, host STRING, member STRING, event_name STRING, event_time TIMESTAMP, x DOUBLE"


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def recursion(rows, keys, gap, event, value, tau=TAU, decay_to_read=False, whole_seconds=False):
    """Sort a key's events by the time they become visible, fold them, read the state at each target."""

    def felt(t):
        return t.replace(microsecond=0) if whole_seconds else t

    out = {}
    for target in rows:
        if target["event_name"] != "target":
            continue
        seen = sorted(
            (r for r in rows
             if r["event_name"] == event and all(r[k] == target[k] for k in keys)
             and r["event_time"] + gap <= target["event_time"]),
            key=lambda r: r["event_time"],
        )
        state, last = 0.0, None
        for r in seen:
            if last is not None:
                state *= math.exp(-(felt(r["event_time"]) - last) / tau)
            state, last = state + value(r), felt(r["event_time"])
        if decay_to_read and last is not None:
            state *= math.exp(-(target["event_time"] - last) / tau)
        out[target["event_id"]] = state
    return out


def frame(spark, rows):
    return spark.createDataFrame(
        [(r["event_id"], r["host"], r["member"], r["event_name"], r["event_time"], r["x"]) for r in rows], SCHEMA
    )


def run(spark, rows, key_sets, **options):
    df = frame(spark, rows)
    out = decayed_counters(
        df, df.where("event_name = 'target'"), key_sets=key_sets, counters=COUNTERS, gaps=GAPS, **options
    )
    return {r["event_id"]: r.asDict() for r in out.collect()}


def check(spark, rows, key_sets, **options):
    got = run(spark, rows, key_sets, **options)
    modes = {k: v for k, v in options.items() if k in ("decay_to_read", "whole_seconds")}
    assert set(got) == {r["event_id"] for r in rows if r["event_name"] == "target"}
    for keys in key_sets:
        for gap in GAPS:
            for c, value in ((COUNTERS[0], lambda r: r["x"]), (COUNTERS[1], lambda r: 1.0)):
                want = recursion(rows, keys, gap, c.event, value, **modes)
                for event_id, expected in want.items():
                    assert got[event_id][feature_name(keys, gap, c.name)] == pytest.approx(expected, rel=1e-9, abs=1e-9)


def skewed_rows(n=600, seed=1):
    """A third of all rows on one host, in bursts and with shared instants."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        burst = rnd.choice([0, 40_000, 200_000])
        rows.append(
            {
                "event_id": i,
                "host": "hot" if i % 3 == 0 else f"h{rnd.randrange(40)}",
                "member": f"m{rnd.randrange(5)}",
                "event_name": rnd.choice(["pay", "visit", "target", "noise"]),
                "event_time": at(burst + rnd.randrange(4000)),
                "x": rnd.random() * 10,
            }
        )
    return rows


def one_key(*events):
    return [
        {"event_id": i, "host": "h", "member": "m", "event_name": name, "event_time": t, "x": 1.0}
        for i, (name, t) in enumerate(events)
    ]


def test_three_events_a_decay_time_apart(spark):
    tau = TAU.total_seconds()
    gap = GAPS[0].total_seconds()
    rows = one_key(
        ("pay", at(0)),
        ("pay", at(tau)),
        ("pay", at(2 * tau)),
        ("target", at(2 * tau + gap)),
        ("target", at(2 * tau + gap) - timedelta(microseconds=1)),
    )
    got = run(spark, rows, [["host"]])
    name = feature_name(["host"], GAPS[0], "amount")
    assert got[3][name] == pytest.approx(1 + math.exp(-1) + math.exp(-2))
    assert got[4][name] == pytest.approx(1 + math.exp(-1))  # the read itself does not decay


def test_nothing_visible_gives_zero(spark):
    got = run(spark, one_key(("target", at(0)), ("pay", at(10)), ("noise", at(1))), [["host"]])
    assert got[0][feature_name(["host"], GAPS[0], "amount")] == 0.0


def test_targets_never_feed_counters(spark):
    rows = one_key(("target", at(0)), ("target", at(10_000)))
    df = frame(spark, rows)
    counters = [Counter("targets", "pay", "1.0")]
    out = decayed_counters(df.where("event_name = 'pay'"), df, key_sets=[["host"]], counters=counters, gaps=GAPS)
    assert {r[-1] for r in out.collect()} == {0.0}


KEY_SETS = [["host"], ["member"], ["host", "member"]]


@pytest.mark.parametrize("options", [{}, {"decay_to_read": True}, {"whole_seconds": True}])
def test_plain_keys(spark, options):
    check(spark, skewed_rows(), KEY_SETS, **options)


@pytest.mark.parametrize("rows_per_block", [1, 15, 60])
def test_blocked_keys(spark, rows_per_block):
    check(spark, skewed_rows(), KEY_SETS, policy=HotKeys(rows_per_block=rows_per_block))


def test_blocked_modes(spark):
    check(spark, skewed_rows(seed=2), KEY_SETS, policy=HotKeys(rows_per_block=20), decay_to_read=True)


def test_hot_key_is_cut_and_others_are_not(spark):
    rows = frame(spark, skewed_rows()).selectExpr("host", "unix_micros(event_time) AS us")
    blocked = split_hot_keys(rows, ["host"], "us", HotKeys(rows_per_block=100))
    blocks = {r["host"]: r["n"] for r in blocked.rows.groupBy("host").agg({"_block": "max"}).toDF("host", "n").collect()}
    assert blocks["hot"] > 0
    assert all(n == 0 for host, n in blocks.items() if host != "hot")
    assert blocked.rows.count() == 600
    assert {r["host"] for r in blocked.hot.select("host").distinct().collect()} == {"hot"}


def test_a_burst_is_cut_too(spark):
    """Nearly all rows of the hot key within a second of a month: blocks follow the rows, not the clock."""
    rows = spark.range(20_000).selectExpr("'k' AS host", "IF(id < 100, id * 26000000000L, 5000000000L + id * 50) AS us")
    blocked = split_hot_keys(rows, ["host"], "us", HotKeys(rows_per_block=1000))
    sizes = [r["count"] for r in blocked.rows.groupBy("_block").count().collect()]
    assert len(sizes) > 15
    assert max(sizes) < 4000


@pytest.mark.parametrize("max_hot", [2, 4])
def test_blocks_do_not_grow_where_a_level_has_few_parts(spark, max_hot):
    """More hot keys than a sketch may name, and more blocks than one level has parts."""
    rows = spark.range(30_000).selectExpr("CAST(IF(id % 2 = 0, 0, id % 14) AS STRING) AS host", "id * id AS us")
    blocked = split_hot_keys(rows, ["host"], "us", HotKeys(rows_per_block=500, max_hot=max_hot))
    cut = blocked.rows.groupBy("host", "_block")
    found = cut.agg({"us": "min"}).join(cut.count(), ["host", "_block"]).toDF("host", "block", "low", "n").collect()
    assert len(found) > 45 and max(r["n"] for r in found) < 2_000
    for host in {r["host"] for r in found}:
        lows = [r["low"] for r in sorted(found, key=lambda r: r["block"]) if r["host"] == host]
        assert lows == sorted(lows) and len(lows) > 1
    assert blocked.hot.count() == 30_000


def test_counters_of_many_levels(spark):
    check(spark, skewed_rows(), KEY_SETS, policy=HotKeys(rows_per_block=10, max_hot=2))


def test_no_hot_key_no_blocks(spark):
    rows = frame(spark, skewed_rows()).selectExpr("host", "unix_micros(event_time) AS us")
    blocked = split_hot_keys(rows, ["host"], "us", HotKeys())
    assert blocked.hot is None
    assert blocked.with_carry(None) is blocked.rows


def test_start_drops_early_targets(spark):
    rows = skewed_rows(90)
    got = run(spark, rows, [["host"]], start=at(40_000))
    assert set(got) == {r["event_id"] for r in rows if r["event_name"] == "target" and r["event_time"] >= at(40_000)}


@pytest.mark.parametrize("rows_per_block", [20, 100_000])
@pytest.mark.parametrize("options", [{}, {"decay_to_read": True}, {"whole_seconds": True}])
def test_any_span(spark, options, rows_per_block):
    """Decay times from far below to above a 600th of the span: bursts, gaps of many anchor blocks, and one common origin."""
    rows, rnd = skewed_rows(500, seed=3), random.Random(4)
    for r in rows:
        r["event_time"] = at(rnd.choice([0, 25, 290, 310, 900, 7_000, 200_000]) + rnd.random() * 40)
    taus = [timedelta(milliseconds=200), timedelta(seconds=1), timedelta(seconds=90), TAU]
    counters = [Counter(f"{c.name}{t}", c.event, c.value, tau) for t, tau in enumerate(taus) for c in COUNTERS]
    gaps = [timedelta(0), timedelta(seconds=20)]
    df = frame(spark, rows)
    out = decayed_counters(
        df, df.where("event_name = 'target'"), key_sets=KEY_SETS, counters=counters, gaps=gaps,
        policy=HotKeys(rows_per_block=rows_per_block), **options,
    )
    got = {r["event_id"]: r.asDict() for r in out.collect()}
    for keys in KEY_SETS:
        for gap in gaps:
            for c in counters:
                value = (lambda r: r["x"]) if c.event == "pay" else (lambda r: 1.0)
                for event_id, expected in recursion(rows, keys, gap, c.event, value, c.tau, **options).items():
                    assert got[event_id][feature_name(keys, gap, c.name)] == pytest.approx(expected, rel=1e-9, abs=1e-12)


def test_a_value_lasts_over_empty_anchor_blocks(spark):
    rows = one_key(("pay", at(0)), ("pay", at(1)), ("target", at(10**7)), ("pay", at(2 * 10**7)), ("target", at(3 * 10**7)))
    df = frame(spark, rows)
    counters = [Counter("amount", "pay", "x", timedelta(seconds=1))]
    out = decayed_counters(df, df.where("event_name = 'target'"), key_sets=[["host"]], counters=counters, gaps=GAPS)
    got = {r["event_id"]: r["feature_host_1h0m0s_amount"] for r in out.collect()}
    assert got == {2: pytest.approx(1 + math.exp(-1)), 4: pytest.approx(1.0)}


def test_no_rows_at_all(spark):
    df = frame(spark, one_key(("target", at(0)))).where("false")
    out = decayed_counters(df, df, key_sets=[["host"]], counters=COUNTERS, gaps=GAPS)
    assert out.collect() == []


def test_event_names_with_quotes(spark):
    rows = one_key(("it's", at(0)), ("target", at(7200)))
    df = frame(spark, rows)
    counters = [Counter("n", "it's", "1.0")]
    out = decayed_counters(df, df.where("event_name = 'target'"), key_sets=[["host"]], counters=counters, gaps=GAPS)
    assert out.first()["feature_host_1h0m0s_n"] == 1.0


def test_standard_names():
    names = [feature_name(["hostId", "memberId"], timedelta(days=1), c.name) for c in livestream_counters()]
    assert names[0] == "feature_hostId_memberId_24h0m0s_timespent_decay_720h0m0s"
    assert len(set(names)) == 7


event = st.tuples(
    st.sampled_from(["pay", "visit", "target"]),
    st.sampled_from(["a", "b"]),
    st.integers(0, 8000),
    st.floats(0, 100, allow_nan=False),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(event, min_size=1, max_size=40), st.sampled_from([2, 1000]))
def test_any_events(spark, events, rows_per_block):
    rows = [
        {"event_id": i, "host": h, "member": "m", "event_name": n, "event_time": at(t), "x": x}
        for i, (n, h, t, x) in enumerate(events)
    ]
    check(spark, rows, [["host"]], policy=HotKeys(rows_per_block=rows_per_block))
