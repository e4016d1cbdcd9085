"""Topics, normalisation and online counters."""

from __future__ import annotations

import json
import math
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from tidemark.operators.counters import Counter
from tidemark.streaming import events as ev
from tidemark.streaming import online

# The four messages every topic carries
TIMES = [1683116230000, 1683116240000, 1683116250000, 1683116550000]
STREAMS = ["livestreamId1", "livestreamId1", "livestreamId2", "livestreamId3"]
HOSTS = ["hostId1", "hostId1", "hostId1", "hostId2"]
MEMBER = "authorId1"


def message(topic, i):
    base = {"time": TIMES[i]}
    if topic == "gift":
        return {**base, "entity": "livestream", "entityId": STREAMS[i], "recipientId": HOSTS[i], "senderId": MEMBER,
                "giftCount": 1, "fromAmount": 2.0 + i}
    base.update(livestreamId=STREAMS[i], hostId=HOSTS[i])
    who = {"comment": {"authorId": MEMBER}, "follow": {"followerId": MEMBER, "followeeId": HOSTS[i]}}
    base.update(who.get(topic, {"memberId": MEMBER}))
    if topic == "like":
        base.update(shortPressCount=1 + i, longPressCount=2 + i)
    return base


def write_topics(tmp_path):
    for topic in ev.TOPICS:
        folder = tmp_path / topic
        folder.mkdir()
        for i in range(4):
            (folder / f"{i}.json").write_text(json.dumps(message(topic, i)) + "\n")


def test_six_topics_in_one_shape(spark, tmp_path):
    write_topics(tmp_path)
    topics = {t: ev.file_topic(spark, t, str(tmp_path / t), files_per_trigger=1) for t in ev.TOPICS}
    merged = ev.merge_topics(topics)
    online.drain(merged, str(tmp_path / "out"), str(tmp_path / "progress"), mode="append")
    schema = ", ".join(f"{n} {t}" for n, t in merged.dtypes)
    got = online.appended(spark, str(tmp_path / "out"), schema).selectExpr("*", "unix_millis(event_time) AS ms").collect()
    assert len(got) == 24
    for r in got:
        i = TIMES.index(r["ms"])
        assert (r["livestreamId"], r["hostId"], r["memberId"]) == (STREAMS[i], HOSTS[i], MEMBER)
        assert r["quantity"] == (3 + 2 * i if r["event_name"] == "like" else 1)
        assert r["amount"] == (2.0 + i if r["event_name"] == "gift" else None)


def test_a_malformed_message_raises(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "0.json").write_text('{"time": "soon"}\n')
    stream = ev.normalise("share", ev.file_topic(spark, "share", str(tmp_path / "in")))
    with pytest.raises(Exception):
        online.drain(stream, str(tmp_path / "out"), str(tmp_path / "progress"), mode="append")


def test_kafka_needs_its_packages(spark):
    with pytest.raises(Exception):
        ev.kafka_topic(spark, "share", "localhost:1", "shares", "{}")


def test_late_events_count(spark, tmp_path):
    """Micro-batches in reverse time order give the state of the right order."""
    start = datetime(2024, 1, 1, tzinfo=UTC)
    counters = [Counter("amount", "pay", "x", timedelta(days=1))]
    (tmp_path / "in").mkdir()
    schema = "k STRING, event_name STRING, event_time TIMESTAMP, x DOUBLE"
    for i, hours in enumerate([30, 20, 10]):
        row = {"k": "a", "event_name": "pay", "event_time": (start + timedelta(hours=hours)).isoformat(), "x": 1.0}
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps(row) + "\n")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    state = online.online_counters(stream, ["k"], counters)
    out = str(tmp_path / "out")
    online.drain(state, out, str(tmp_path / "progress"))
    ddl = ", ".join(f"{n} {t}" for n, t in state.dtypes)
    latest = online.latest_state(spark, out, ddl, ["k", "anchor"])
    got = online.counter_values(latest, ["k"], counters).first()["amount"]
    assert got == pytest.approx(1 + math.exp(-10 / 24) + math.exp(-20 / 24))

    # a restart goes on where the last run stopped
    row = {"k": "a", "event_name": "pay", "event_time": (start + timedelta(hours=30)).isoformat(), "x": 5.0}
    (tmp_path / "in" / "3.json").write_text(json.dumps(row) + "\n")
    online.drain(state, out, str(tmp_path / "progress"))
    got = online.counter_values(online.latest_state(spark, out, ddl, ["k", "anchor"]), ["k"], counters)
    assert got.first()["amount"] == pytest.approx(6 + math.exp(-10 / 24) + math.exp(-20 / 24))


def test_any_span_online(spark):
    """A decay time of a second over months, beside one of a month."""
    start = datetime(2024, 1, 1, tzinfo=UTC)
    taus = {"second": timedelta(seconds=1), "month": timedelta(days=30)}
    counters = [Counter(name, "pay", "x", tau) for name, tau in taus.items()]
    seconds = [0.0, 0.5, 299.9, 300.1, 301.0, 5e6, 5e6 + 2]
    rows = [("a", "pay", start + timedelta(seconds=t), 1.0 + i) for i, t in enumerate(seconds)]
    events = spark.createDataFrame(rows, "k STRING, event_name STRING, event_time TIMESTAMP, x DOUBLE")
    got = online.counter_values(online.online_counters(events, ["k"], counters), ["k"], counters).first()
    for name, tau in taus.items():
        want = sum((1 + i) * math.exp((t - seconds[-1]) / tau.total_seconds()) for i, t in enumerate(seconds))
        assert got[name] == pytest.approx(want, rel=1e-9)


def test_the_log_stays_bounded(spark, tmp_path):
    """Many batches of updates of few keys: what is read does not grow with the batches, and nothing is lost."""
    out, log = str(tmp_path / "out"), tmp_path / "out"
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema("k STRING, x INT").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    counted = stream.groupBy("k").agg({"x": "sum"}).toDF("k", "total")

    def totals():
        return {r["k"]: r["total"] for r in online.latest_state(spark, out, "k STRING, total BIGINT", ["k"]).collect()}

    want = {}
    for i in range(11):
        (tmp_path / "in" / f"{i:02}.json").write_text(json.dumps({"k": f"k{i % 4}", "x": i}) + "\n")
        want[f"k{i % 4}"] = want.get(f"k{i % 4}", 0) + i
        if i in (5, 10):  # a restart in between
            online.drain(counted, out, str(tmp_path / "progress"), keys=["k"], compact_every=3)
            assert totals() == want
    assert len(list(log.glob("batch=*"))) <= 2 * 3 and len(list(log.glob("_snapshots/upto=*"))) <= 2
    # a snapshot that was not committed does not count
    broken = log / "_snapshots" / "upto=99"
    broken.mkdir()
    assert totals() == want


def test_a_watermark_forgets_old_blocks(spark, tmp_path):
    start = datetime(2024, 1, 1, tzinfo=UTC)
    counters = [Counter("amount", "pay", "x", timedelta(seconds=1))]
    (tmp_path / "in").mkdir()
    schema = "k STRING, event_name STRING, event_time TIMESTAMP, x DOUBLE"
    for i, seconds in enumerate([0, 10_000, 20_000, 30_000]):
        row = {"k": "a", "event_name": "pay", "event_time": (start + timedelta(seconds=seconds)).isoformat(), "x": 1.0 + i}
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps(row) + "\n")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    state = online.online_counters(stream, ["k"], counters, watermark="60 seconds")
    query = state.writeStream.format("memory").queryName("forgets").outputMode("update").trigger(availableNow=True)
    running = query.option("checkpointLocation", str(tmp_path / "progress")).start()
    running.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in running.recentProgress if p["stateOperators"]) <= 2
    got = online.counter_values(spark.table("forgets"), ["k"], counters).first()["amount"]
    assert got == pytest.approx(4.0)


def test_replayed_files_can_be_shared_out(spark, monkeypatch):
    """A micro-batch of a single file has work for more than one task."""
    from tidemark.plans import streams

    monkeypatch.setattr(streams, "ROW_GROUP", 1 << 16)
    rows = spark.range(40_000).selectExpr("id", "md5(CAST(id AS STRING)) AS value").repartition(spark.sparkContext.defaultParallelism)
    path, _ = streams.written(rows, "lines")
    files = list(Path(path.removeprefix("file://")).glob("*.parquet"))
    assert files and all(pq.ParquetFile(f).num_row_groups > 1 for f in files)
    assert spark.read.parquet(path).count() == 40_000


def test_the_log_is_read_without_sorting(spark, tmp_path):
    """Batches are aggregated by hash; a snapshot with nothing after it is read as it is."""
    out, schema = str(tmp_path / "out"), "k STRING, n BIGINT, m DOUBLE"
    for number, rows in enumerate([[("a", 1, 1.0), ("b", 1, 2.0), (None, 1, None)], [("a", 2, None), (None, 2, 0.5)]]):
        spark.createDataFrame(rows, schema).write.parquet(f"{out}/batch={number}")
    want = {("a", 2, None), ("b", 1, 2.0), (None, 2, 0.5)}
    for needed in (["HashAggregate"], []):
        latest = online.latest_state(spark, out, schema, ["k"])
        assert {tuple(r) for r in latest.collect()} == want and latest.columns == ["k", "n", "m"]
        plan = latest._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and ("Exchange" in plan) == bool(needed) and all(x in plan for x in needed)
        online.compact(spark, out, schema, ["k"], 1)
    assert online.latest_state(spark, str(tmp_path / "none"), schema, ["k"]).count() == 0
