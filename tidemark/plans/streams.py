"""Streaming queries: the tables replayed as several micro-batches, drained, and read back."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import whitespace_tokens
from tidemark.functions.times import gap_micros
from tidemark.operators.counters import STANDARD_TAU, Counter
from tidemark.operators.wordcount import count_words
from tidemark.plans.registry import ORACLES, query
from tidemark.plans.sources_yield import rounded
from tidemark.plans.temporal import COUNTERS, INTERACTIONS_SQL
from tidemark.plans.words import document_lines
from tidemark.session import scratch_path
from tidemark.sources import writers
from tidemark.sources.tables import interactions, spread
from tidemark.streaming import events as ev
from tidemark.streaming import online

MICRO_BATCHES = 4
#: Bytes of a row group: a micro-batch has few files, which its tasks share by row groups.
ROW_GROUP = 8 << 20


def replay(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written as files and read back as a stream of a few micro-batches."""
    path, files = written(rows, name)
    stream = rows.sparkSession.readStream.schema(rows.schema)
    return stream.option("maxFilesPerTrigger", files).parquet(path)


def written(rows: DataFrame, name: str, json: bool = False) -> tuple[str, int]:
    """A folder holding ``rows``, and how many of its files make up a micro-batch."""
    rows = spread(rows)
    path = scratch_path(rows.sparkSession, name)
    if json:
        writers.text(rows, writers.json_line(), path)
    else:
        rows.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return path, max(1, rows.rdd.getNumPartitions() // MICRO_BATCHES)


def ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


# which table event plays which topic
TOPIC_OF = {
    "like": "event_type = 'click'",
    "gift": "event_type = 'purchase'",
    "cohost_request": "event_type = 'signup'",
    "comment": "event_type = 'view' AND event_id % 2 = 0",
    "share": "event_type = 'error'",
    "follow": "event_type = 'view' AND event_id % 2 = 1",
}
TOPIC_FIELDS = {
    "livestreamId": "CAST(segment AS STRING)",
    "hostId": "CAST(k AS STRING)",
    "memberId": "CAST(user_id AS STRING)",
    "shortPressCount": "k % 5",
    "longPressCount": "k % 3",
    "entity": "'livestream'",
    "entityId": "CAST(segment AS STRING)",
    "recipientId": "CAST(k AS STRING)",
    "senderId": "CAST(user_id AS STRING)",
    "giftCount": "k % 7",
    "fromAmount": "k / 4D",
    "authorId": "CAST(user_id AS STRING)",
    "followerId": "CAST(user_id AS STRING)",
    "followeeId": "CASE WHEN k % 2 = 0 THEN CAST(k AS STRING) END",
    "time": "unix_millis(CAST(ts AS TIMESTAMP))",
}


def topic_rows(spark: SparkSession, sf_dir: str, topic: str) -> DataFrame:
    """The table's events as one topic would publish them."""
    fields = [f.split() for f in ev.TOPICS[topic].split(", ")]
    return (
        interactions(spark, sf_dir)
        .where(TOPIC_OF[topic])
        .selectExpr(*[f"CAST({TOPIC_FIELDS[name]} AS {kind}) AS {name}" for name, kind in fields])
    )


NORMALISED_SQL = f"""
WITH e AS ({INTERACTIONS_SQL})
SELECT CASE event_type WHEN 'click' THEN 'like' WHEN 'purchase' THEN 'gift' WHEN 'signup' THEN 'cohost_request'
           WHEN 'error' THEN 'share' ELSE CASE WHEN event_id % 2 = 0 THEN 'comment' ELSE 'follow' END END AS event_name,
       CAST(segment AS VARCHAR) AS "livestreamId", CAST(k AS VARCHAR) AS "hostId", CAST(user_id AS VARCHAR) AS "memberId",
       CAST(CASE event_type WHEN 'click' THEN k % 5 + k % 3 WHEN 'purchase' THEN k % 7 ELSE 1 END AS BIGINT) AS quantity,
       CASE WHEN event_type = 'purchase' THEN k / 4.0 END AS amount, us // 1000 AS millis
FROM e"""


def with_millis(rows: DataFrame) -> DataFrame:
    return rows.withColumn("millis", F.unix_millis("event_time")).drop("event_time")


@query("event_normalise", NORMALISED_SQL)
def event_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_millis(ev.merge_topics({t: topic_rows(spark, sf_dir, t) for t in ev.TOPICS}))


@query("stream_event_normalise", NORMALISED_SQL)
def stream_event_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six folders of JSON messages merged by one stream."""
    topics = {}
    for topic in ev.TOPICS:
        folder, files = written(topic_rows(spark, sf_dir, topic), topic, json=True)
        topics[topic] = ev.file_topic(spark, topic, folder, files)
    merged = with_millis(ev.merge_topics(topics))
    out = scratch_path(spark, "merged")
    online.drain(merged, out, scratch_path(spark, "merged-progress"), mode="append")
    return online.appended(spark, out, ddl(merged))


@query("stream_wordcount", ORACLES["wordcount_whitespace"])
def stream_wordcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = replay(document_lines(spark, sf_dir), "lines")
    counted = count_words(lines, whitespace_tokens(F.col("value")))
    out = scratch_path(spark, "words")
    online.drain(counted, out, scratch_path(spark, "words-progress"), keys=["word"], compact_every=2)
    return online.latest_state(spark, out, ddl(counted), ["word"])


def online_oracle(tau: timedelta = STANDARD_TAU) -> str:
    cells = []
    for c in COUNTERS:
        last = f"max(us) FILTER (event_type = '{c.event}') OVER (PARTITION BY user_id)"
        cells.append(f"CASE WHEN event_type = '{c.event}' THEN ({c.value}) * exp((us - {last}) / {float(gap_micros(tau))}) END AS {c.name}")
    sums = ", ".join(f"round(coalesce(sum({c.name}), 0.0), 4) AS {c.name}" for c in COUNTERS)
    return f"""
WITH e AS ({INTERACTIONS_SQL}), w AS (SELECT user_id, {', '.join(cells)} FROM e WHERE event_type <> 'purchase')
SELECT user_id, {sums} FROM w GROUP BY user_id"""


#: The counters with a decay time that the events' span holds many hundred times.
HOURLY = [replace(c, tau=timedelta(hours=1)) for c in COUNTERS]
STATE_KEYS = ["user_id", "anchor"]


def finish(state: DataFrame, counters: list[Counter] = COUNTERS) -> DataFrame:
    return rounded(online.counter_values(state, ["user_id"], counters), 4)


def online_state(rows: DataFrame, counters: list[Counter] = COUNTERS) -> DataFrame:
    return online.online_counters(rows, ["user_id"], counters, time="ts", event_name="event_type")


@query("online_counters_batch", online_oracle())
def online_counters_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return finish(online_state(interactions(spark, sf_dir)))


@query("online_counters_hour", online_oracle(timedelta(hours=1)))
def online_counters_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decay within an hour over all of the events' time."""
    return finish(online_state(interactions(spark, sf_dir), HOURLY), HOURLY)


def streamed(spark: SparkSession, sf_dir: str, counters: list[Counter]) -> DataFrame:
    """The values from micro-batches whose rows arrive out of order; the log of updates is compacted on the way."""
    state = online_state(replay(interactions(spark, sf_dir), "events"), counters)
    out = scratch_path(spark, "counters")
    online.drain(state, out, scratch_path(spark, "counters-progress"), keys=STATE_KEYS, compact_every=2)
    return finish(online.latest_state(spark, out, ddl(state), STATE_KEYS), counters)


@query("stream_decayed_counters", online_oracle())
def stream_decayed_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed(spark, sf_dir, COUNTERS)


@query("stream_decayed_counters_hour", online_oracle(timedelta(hours=1)))
def stream_decayed_counters_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streamed(spark, sf_dir, HOURLY)
