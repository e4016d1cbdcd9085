"""Null keys, labels and sequences, doubled tokens, and quoted names."""

from __future__ import annotations

import math
from datetime import datetime, timedelta

from test_features import config

from tidemark.operators.asof import asof_join
from tidemark.operators.counters import Counter, decayed_counters
from tidemark.operators.describe import describe_by
from tidemark.operators.features import transform_features
from tidemark.operators.sampling import balanced_weights, exact_sample
from tidemark.streaming import online

DAY = timedelta(days=1)
START = datetime(2024, 1, 1)


def test_a_null_key_has_no_past(spark):
    rows = [(1, "a", "x", START), (2, None, "x", START), (3, "a", "t", START + DAY), (4, None, "t", START + DAY), (None, "a", "t", START + DAY)]
    df = spark.createDataFrame(rows, "event_id INT, k STRING, event_name STRING, event_time TIMESTAMP")
    out = decayed_counters(
        df, df.where("event_name = 't'"), key_sets=[["k"]], counters=[Counter("n", "x", "1.0", DAY)], gaps=[timedelta(hours=1)],
        decay_to_read=True,
    )
    got = {r[0]: r[-1] for r in out.select("event_id", out.columns[-1]).collect()}
    assert math.isclose(got[3], math.exp(-1)) and got[4] == 0.0 and got[None] is None
    left, right = df.where("event_name = 't'"), df.where("event_name = 'x'").withColumnRenamed("event_id", "seen")
    joined = asof_join(left, right, by=["k"], left_time="event_time", right_time="event_time", columns=["seen"], right_id="seen")
    assert {(r.event_id, r.seen) for r in joined.collect()} == {(3, 1), (4, None), (None, 1)}


def test_samples_and_weights(spark):
    df = spark.createDataFrame([(None, 1), (None, 0), (3, 1), (4, 0), (5, None), (6, 0)], "id INT, label INT")
    assert exact_sample(df, "id", n=1).where("in_sample").count() == 1
    assert not exact_sample(df, "id", fraction=1.0).where("in_sample AND id IS NULL").count()
    by = exact_sample(df, "id", n=1, by="label").where("in_sample").collect()
    assert sorted(r.label for r in by) == [0, 1] and all(r.id is not None for r in by)
    got = balanced_weights(df, "label").collect()
    assert len(got) == 6 and {r.label: r.weight for r in got} == {1: 5 / 4, 0: 5 / 6, None: None}


def test_a_null_label_is_described(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), (1, 5.0)], "label INT, v DOUBLE")
    got = {r.label: (r["mean"], r["p50"]) for r in describe_by(df, "label", ["v"]).collect()}
    assert got == {None: (2.0, 2.0), 1: (5.0, 5.0)}


def test_null_sequences_keep_their_rows(spark):
    rows = spark.createDataFrame(
        [("p", 10, 1, 1, None), (None, None, 2, 0, "20")], "pp STRING, host BIGINT, member BIGINT, label BIGINT, history STRING"
    )
    vocabulary = spark.createDataFrame([(10, 0), (20, 1), (20, 2)], "token BIGINT, index BIGINT")
    got = {r.member: (r.history, r.label) for r in transform_features(rows, config(), {"host": vocabulary}, "member").collect()}
    assert got == {1: ([3, 3, 3, 3], 1), 2: ([1, 3, 3, 3], 0)}


def test_event_names_may_hold_quotes(spark):
    df = spark.createDataFrame([("a", "it's", START)], "k STRING, event_name STRING, event_time TIMESTAMP")
    counters = [Counter("n", "it's", "1.0", DAY)]
    state = online.online_counters(df, ["k"], counters)
    assert online.counter_values(state, ["k"], counters).first()["n"] == 1.0
