"""Decayed counters, delayed histories and as-of joins."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import gap_micros
from tidemark.operators.asof import asof_join
from tidemark.operators.counters import STANDARD_GAPS, STANDARD_TAU, Counter, decayed_counters, feature_name
from tidemark.operators.history import delayed_history
from tidemark.operators.hotkeys import HotKeys
from tidemark.plans.registry import query
from tidemark.sources.tables import interactions, table

# purchases are the targets; every other event type feeds counters
COUNTERS = [
    Counter("view_value", "view", "value"),
    Counter("long_views", "view", "CASE WHEN value > 90 THEN 1.0 ELSE 0.0 END"),
    Counter("click_value", "click", "value"),
    Counter("signup_quantity", "signup", "k"),
    Counter("signup_amount", "signup", "value * k"),
    Counter("errors", "error", "1.0"),
    Counter("clicks", "click", "1.0"),
]
KEY_SETS = [["k"], ["user_id"], ["segment"], ["k", "user_id"]]
DIGITS = 4

INTERACTIONS_SQL = """
    SELECT event_id, ts, epoch_us(ts) AS us, user_id, CAST(props->>'$.k' AS INTEGER) AS k,
           user_id % 50 AS segment, event_type, value
    FROM events"""


def counters_oracle(key_sets: list[list[str]]) -> str:
    tau = float(gap_micros(STANDARD_TAU))
    cells, windows = [], []
    for s, keys in enumerate(key_sets):
        for g, gap in enumerate(STANDARD_GAPS):
            w = f"w{s}_{g}"
            windows.append(
                f"{w} AS (PARTITION BY {', '.join(keys)} ORDER BY us "
                f"RANGE BETWEEN UNBOUNDED PRECEDING AND {gap_micros(gap)} PRECEDING)"
            )
            for c in COUNTERS:
                weighted = f"CASE WHEN event_type = '{c.event}' THEN ({c.value}) * exp((us - t0) / {tau}) END"
                last = f"CASE WHEN event_type = '{c.event}' THEN us END"
                cells.append(
                    f"round(coalesce(sum({weighted}) OVER {w} * exp((t0 - max({last}) OVER {w}) / {tau}), 0.0), "
                    f"{DIGITS}) AS {feature_name(keys, gap, c.name)}"
                )
    return f"""
WITH e AS ({INTERACTIONS_SQL}), b AS (SELECT *, (SELECT min(us) FROM e) AS t0 FROM e),
f AS (SELECT event_id, user_id, k, segment, event_type, {', '.join(cells)} FROM b WINDOW {', '.join(windows)})
SELECT * EXCLUDE (event_type) FROM f WHERE event_type = 'purchase'"""


def short_oracle(keys: str, tau: timedelta) -> str:
    """Every visible event of every target, as of the counter's last one: nothing overflows, over any span."""
    parts = []
    for gap in STANDARD_GAPS:
        for c in COUNTERS:
            last = "max(e.us) OVER (PARTITION BY t.event_id)"
            parts.append(
                f"SELECT t.event_id, '{feature_name([keys], gap, c.name)}' AS name, "
                f"e.x * exp((e.us - {last}) / {float(gap_micros(tau))}) AS x "
                f"FROM t JOIN (SELECT {keys}, us, {c.value} AS x FROM e WHERE event_type = '{c.event}') e "
                f"ON e.{keys} = t.{keys} AND e.us <= t.us - {gap_micros(gap)}"
            )
    names = [feature_name([keys], gap, c.name) for gap in STANDARD_GAPS for c in COUNTERS]
    cells = ", ".join(f"round(coalesce(sum(x) FILTER (name = '{n}'), 0.0), {DIGITS}) AS {n}" for n in names)
    return f"""
WITH e AS ({INTERACTIONS_SQL}), t AS (SELECT event_id, us, user_id, k, segment FROM e WHERE event_type = 'purchase'),
x AS ({' UNION ALL '.join(parts)}),
f AS (SELECT event_id, {cells} FROM x GROUP BY event_id)
SELECT t.event_id, t.user_id, t.k, t.segment, {', '.join(f'coalesce(f.{n}, 0.0) AS {n}' for n in names)}
FROM t LEFT JOIN f ON f.event_id = t.event_id"""


def run_counters(
    spark: SparkSession,
    sf_dir: str,
    key_sets: list[list[str]],
    policy: HotKeys = HotKeys(),
    counters: list[Counter] = COUNTERS,
) -> DataFrame:
    rows = interactions(spark, sf_dir)
    out = decayed_counters(
        rows,
        rows.where(F.col("event_type") == "purchase"),
        key_sets=key_sets,
        counters=counters,
        time="ts",
        event_name="event_type",
        policy=policy,
    )
    features = [f"round({c}, {DIGITS}) AS {c}" for c in out.columns if c.startswith("feature_")]
    return out.selectExpr("event_id", "user_id", "k", "segment", *features)


for _name, _key_sets in {
    "decayed_counters_user": [["user_id"]],
    "decayed_counters_k": [["k"]],
    "decayed_counters_segment": [["segment"]],
    "decayed_counters_user_k": [["k", "user_id"]],
    "decayed_counters_all": KEY_SETS,
}.items():
    query(_name, counters_oracle(_key_sets))(partial(run_counters, key_sets=_key_sets))

# the same features with every busy key cut into time blocks
query("decayed_counters_blocked", counters_oracle([["segment"], ["k"]]))(
    partial(run_counters, key_sets=[["segment"], ["k"]], policy=HotKeys(rows_per_block=100))
)


# a decay time that the events' span holds many hundred times, with plain and with blocked keys
HOURLY = [replace(c, tau=timedelta(hours=1)) for c in COUNTERS]
for _name, _policy in {"decayed_counters_hour": HotKeys(), "decayed_counters_hour_blocked": HotKeys(rows_per_block=100)}.items():
    query(_name, short_oracle("segment", timedelta(hours=1)))(
        partial(run_counters, key_sets=[["segment"]], policy=_policy, counters=HOURLY)
    )


HISTORY_START = datetime(2024, 1, 3)


def history_oracle(key: str, mode: str) -> str:
    """Rank every interaction, then cut the list of visible ones to the reference length."""
    length = {
        "sawtooth": "CASE WHEN n <= 64 THEN n ELSE 33 + (n - 65) % 32 END",
        "last_k": "least(n, 32)",
    }[mode]
    return f"""
WITH e AS ({INTERACTIONS_SQL}),
h AS (
    SELECT event_id, {key} AS member, us, value > 50 AS positive,
           count(*) OVER w AS n,
           list(k) OVER (w ROWS BETWEEN 63 PRECEDING AND CURRENT ROW) AS recent
    FROM e WINDOW w AS (PARTITION BY {key}, value > 50 ORDER BY us, event_id)
),
cut AS (
    SELECT member, us + 3600000000 AS seen, positive, n,
           array_to_string(recent[len(recent) - ({length}) + 1:], ' ') AS history
    FROM h
),
p AS (SELECT member, seen, max(n) AS n, arg_max(history, n) AS history FROM cut WHERE positive GROUP BY ALL),
m AS (SELECT member, seen, max(n) AS n, arg_max(history, n) AS history FROM cut WHERE NOT positive GROUP BY ALL),
t AS (SELECT event_id, {key} AS member, us FROM e WHERE ts >= TIMESTAMP '2024-01-03')
SELECT t.event_id, t.member, coalesce(p.history, '') AS positives_history, coalesce(m.history, '') AS negatives_history
FROM t
ASOF LEFT JOIN p ON t.member = p.member AND t.us >= p.seen
ASOF LEFT JOIN m ON t.member = m.member AND t.us >= m.seen"""


def run_history(
    spark: SparkSession, sf_dir: str, key: str, mode: str = "sawtooth", policy: HotKeys = HotKeys()
) -> DataFrame:
    rows = interactions(spark, sf_dir).selectExpr("event_id", f"{key} AS member", "ts", "k", "CAST(value > 50 AS INT) AS label")
    out = delayed_history(
        rows,
        member="member",
        item="k",
        label="label",
        time="ts",
        row_id="event_id",
        start=HISTORY_START,
        mode=mode,
        policy=policy,
    )
    return out.selectExpr(
        "event_id",
        "member",
        "array_join(positives_history, ' ') AS positives_history",
        "array_join(negatives_history, ' ') AS negatives_history",
    )


query("user_history", history_oracle("user_id", "sawtooth"))(partial(run_history, key="user_id"))
query("user_history_long", history_oracle("segment", "sawtooth"))(partial(run_history, key="segment"))
query("user_history_last_k", history_oracle("segment", "last_k"))(partial(run_history, key="segment", mode="last_k"))
query("user_history_blocked", history_oracle("segment", "sawtooth"))(
    partial(run_history, key="segment", policy=HotKeys(rows_per_block=60))
)


SOME_USERS = "CASE WHEN user_id % 7 <> 0 THEN user_id END"


def asof_oracle(gap_us: int, tolerance_us: int | None, user: str = "user_id") -> str:
    fresh = "TRUE" if tolerance_us is None else f"v.us >= t.us - {gap_us} - {tolerance_us}"
    return f"""
WITH e AS (SELECT * REPLACE ({user} AS user_id) FROM ({INTERACTIONS_SQL})),
t AS (SELECT * FROM e WHERE event_type = 'purchase'), v AS (SELECT * FROM e WHERE event_type = 'view')
SELECT t.event_id, t.user_id,
       CASE WHEN {fresh} THEN v.event_id END AS view_id, CASE WHEN {fresh} THEN v.value END AS view_value
FROM t ASOF LEFT JOIN v ON t.user_id = v.user_id AND t.us - {gap_us} >= v.us"""


def run_asof(
    spark: SparkSession, sf_dir: str, gap: timedelta, tolerance: timedelta | None = None, policy: HotKeys = HotKeys(),
    user: str = "user_id",
) -> DataFrame:
    events = table(spark, sf_dir, "events").withColumn("user_id", F.expr(user))
    purchases = events.where("event_type = 'purchase'").select("event_id", "ts", "user_id")
    views = events.where("event_type = 'view'").selectExpr("event_id AS view_id", "value AS view_value", "ts", "user_id")
    return asof_join(
        purchases,
        views,
        by=["user_id"],
        left_time="ts",
        right_time="ts",
        columns=["view_id", "view_value"],
        right_id="view_id",
        gap=gap,
        tolerance=tolerance,
        policy=policy,
    ).drop("ts")


_hour, _day = timedelta(hours=1), timedelta(days=1)
query("asof_last_event", asof_oracle(gap_micros(_hour), None))(partial(run_asof, gap=_hour))
query("asof_tolerance", asof_oracle(gap_micros(_hour), gap_micros(_day)))(partial(run_asof, gap=_hour, tolerance=_day))
query("asof_null_keys", asof_oracle(gap_micros(_hour), None, SOME_USERS))(partial(run_asof, gap=_hour, user=SOME_USERS))
query("asof_blocked", asof_oracle(gap_micros(_hour), None))(
    partial(run_asof, gap=_hour, policy=HotKeys(rows_per_block=5))
)
