"""The six event topics, their schemas, and one common event shape."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fields of each topic; every field may be null, time is epoch milliseconds
TOPICS = {
    "like": "livestreamId STRING, hostId STRING, memberId STRING, shortPressCount INT, longPressCount INT, time BIGINT",
    "gift": "entity STRING, entityId STRING, recipientId STRING, senderId STRING, giftCount INT, fromAmount FLOAT, "
    "time BIGINT",
    "cohost_request": "livestreamId STRING, hostId STRING, memberId STRING, time BIGINT",
    "comment": "livestreamId STRING, hostId STRING, authorId STRING, time BIGINT",
    "share": "livestreamId STRING, hostId STRING, memberId STRING, time BIGINT",
    "follow": "livestreamId STRING, hostId STRING, followerId STRING, followeeId STRING, time BIGINT",
}

# livestream, host, member, quantity and amount of a topic, as SQL over its fields
SHAPES = {
    "like": ("livestreamId", "hostId", "memberId", "shortPressCount + longPressCount", "NULL"),
    "gift": ("entityId", "recipientId", "senderId", "giftCount", "fromAmount"),
    "cohost_request": ("livestreamId", "hostId", "memberId", "1", "NULL"),
    "comment": ("livestreamId", "hostId", "authorId", "1", "NULL"),
    "share": ("livestreamId", "hostId", "memberId", "1", "NULL"),
    "follow": ("livestreamId", "coalesce(followeeId, hostId)", "followerId", "1", "NULL"),
}


def normalise(topic: str, rows: DataFrame) -> DataFrame:
    """A topic's rows as (event_name, livestreamId, hostId, memberId, quantity, amount, event_time)."""
    livestream, host, member, quantity, amount = SHAPES[topic]
    return rows.selectExpr(
        f"'{topic}' AS event_name",
        f"{livestream} AS livestreamId",
        f"{host} AS hostId",
        f"{member} AS memberId",
        f"CAST({quantity} AS BIGINT) AS quantity",
        f"CAST({amount} AS DOUBLE) AS amount",
        "timestamp_millis(time) AS event_time",
    )


def merge_topics(topics: Mapping[str, DataFrame]) -> DataFrame:
    """All topics in the common shape; batch or streaming."""
    merged = None
    for topic, rows in topics.items():
        shaped = normalise(topic, rows)
        merged = shaped if merged is None else merged.unionByName(shaped)
    return merged


def file_topic(spark: SparkSession, topic: str, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """A topic as JSON files that keep arriving in a folder."""
    return (
        spark.readStream.schema(TOPICS[topic])
        .options(mode="FAILFAST", maxFilesPerTrigger=files_per_trigger)
        .json(folder)
    )


def _avro():
    try:
        from pyspark.sql.avro import functions as avro
    except ImportError as missing:
        raise RuntimeError("Kafka topics need the spark-avro and spark-sql-kafka packages") from missing
    return avro


def kafka_topic(spark: SparkSession, topic: str, servers: str, name: str, avro_schema: str) -> DataFrame:
    """A topic from Kafka, Avro-encoded. Needs the spark-avro and spark-sql-kafka packages."""
    raw = spark.readStream.format("kafka").options(**{"kafka.bootstrap.servers": servers, "subscribe": name}).load()
    return raw.select(_avro().from_avro("value", avro_schema, {"mode": "FAILFAST"}).alias("e")).select("e.*")


def publish(rows: DataFrame, servers: str, name: str, avro_schema: str, checkpoint: str):
    """Write a stream to Kafka, one Avro record per row: leader acknowledgement, up to five attempts."""
    record = _avro().to_avro(F.struct(*rows.columns), avro_schema).alias("value")
    options = {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "1",
        "kafka.retries": "4",
        "topic": name,
        "checkpointLocation": checkpoint,
    }
    return rows.select(record).writeStream.format("kafka").options(**options).start()
