"""Online counters and word counts as plain streaming aggregations, and a bounded log of their updates.

Within an anchor block of time a decayed sum is an ordinary sum, weighted from the block's start. So it needs no
custom state: one row per key and block, partial aggregation before the shuffle, and rows may arrive in any order,
over any span. Reading rescales a key's blocks to its last event.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import gap_micros, micros
from tidemark.operators.counters import ANCHOR, Counter, quoted

BATCH, SNAPSHOTS, UPTO = "batch", "_snapshots", "upto"
#: Micro-batches after which the log of updates is compacted.
COMPACT_EVERY = 16


def online_counters(
    events: DataFrame,
    keys: Sequence[str],
    counters: Sequence[Counter],
    time: str = "event_time",
    event_name: str = "event_name",
    watermark: str | None = None,
) -> DataFrame:
    """Per key and anchor block (``anchor``, its start in microseconds) the sum and last time of every counter.

    Batch or streaming. Blocks are ``ANCHOR`` times the shortest decay time long. With a ``watermark`` (such as ``7 days``) a
    stream forgets blocks that lie that far behind its last event, and later rows of those; their sums stay in the output.
    """
    names = list(dict.fromkeys(c.event for c in counters))
    timed = events.where(F.col(event_name).isin(names)).withColumns(
        {"_time": F.col(time).cast("timestamp"), "_us": micros(time), "_event": F.col(event_name)}
    )
    if watermark:
        timed = timed.withWatermark("_time", watermark)
    width = ANCHOR * min(gap_micros(c.tau) for c in counters)
    start = F.unix_micros(F.col("_block.start"))
    sums = [
        f"coalesce(sum(CASE WHEN _event = {quoted(c.event)} THEN coalesce(CAST({c.value} AS DOUBLE), 0D) "
        f"* exp((_us - unix_micros(_block.start)) / {gap_micros(c.tau)}D) END), 0D) AS `sum_{c.name}`"
        for c in counters
    ]
    lasts = [f"max(CASE WHEN _event = {quoted(n)} THEN _us END) AS `last_{n}`" for n in names]
    grouped = timed.withColumn("_block", F.window("_time", f"{width} microseconds")).groupBy(*keys, "_block")
    return grouped.agg(*[F.expr(e) for e in sums + lasts]).withColumn("anchor", start).drop("_block")


def counter_values(state: DataFrame, keys: Sequence[str], counters: Sequence[Counter]) -> DataFrame:
    """Counter values of each key as of each counter's last event; 0 before the first one."""
    names = list(dict.fromkeys(c.event for c in counters))
    by_key = f"OVER (PARTITION BY {', '.join(f'`{k}`' for k in keys)})"
    known = state.selectExpr("*", *[f"max(`last_{n}`) {by_key} AS `_end_{n}`" for n in names])

    def value(c: Counter) -> str:
        rescaled = f"`sum_{c.name}` * exp((anchor - `_end_{c.event}`) / {gap_micros(c.tau)}D)"
        return f"coalesce(sum(CASE WHEN `last_{c.event}` IS NOT NULL THEN {rescaled} END), 0D) AS `{c.name}`"

    return known.groupBy(*keys).agg(*[F.expr(value(c)) for c in counters])


def drain(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    mode: str = "update",
    timeout: int | None = None,
    keys: Sequence[str] | None = None,
    compact_every: int = COMPACT_EVERY,
) -> None:
    """Process everything that has arrived, one folder per micro-batch.

    A replayed batch overwrites its own folder, so a restart leaves no duplicates. There is no limit to the
    time it takes unless ``timeout`` sets one, in seconds. With ``keys``, of a log in ``update`` mode, every
    ``compact_every`` batches are compacted.
    """
    schema = ", ".join(f"`{n}` {t}" for n, t in stream.dtypes)

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={number}")
        if keys and (number + 1) % compact_every == 0:
            compact(batch.sparkSession, path, schema, keys, number)

    query = (
        stream.writeStream.foreachBatch(save)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            raise TimeoutError(f"the stream did not finish within {timeout} seconds")
    finally:
        query.stop()


def _folders(spark: SparkSession, path: str, label: str, complete: bool = False) -> list[int]:
    """The numbers of the folders ``label=number`` below ``path``; with ``complete`` only of those whose write was committed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{label}=*" + ("/_SUCCESS" if complete else ""))
    found = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(place) or []
    folders = [status.getPath().getParent() if complete else status.getPath() for status in found]
    return sorted(int(folder.getName().partition("=")[2]) for folder in folders)


def _remove(spark: SparkSession, folder: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def compact(spark: SparkSession, path: str, schema: str, keys: Sequence[str], upto: int) -> None:
    """Write the newest row per key as of batch ``upto`` as a snapshot, and drop what the snapshot before made needless.

    A snapshot counts once it is committed. What it replaces stays until the next one, so that readers that began before
    still find their files.
    """
    older = [n for n in _folders(spark, f"{path}/{SNAPSHOTS}", UPTO, complete=True) if n < upto]
    latest_state(spark, path, schema, keys, upto).write.mode("overwrite").parquet(f"{path}/{SNAPSHOTS}/{UPTO}={upto}")
    for n in _folders(spark, f"{path}/{SNAPSHOTS}", UPTO):
        if older and n < older[-1]:
            _remove(spark, f"{path}/{SNAPSHOTS}/{UPTO}={n}")
    for n in _folders(spark, path, BATCH):
        if older and n <= older[-1]:
            _remove(spark, f"{path}/{BATCH}={n}")


def latest_state(spark: SparkSession, path: str, schema: str, keys: Sequence[str], upto: int | None = None) -> DataFrame:
    """The newest row per key of a log written in ``update`` mode, or as of batch ``upto``.

    Reads the newest snapshot and the batches after it: with compaction, at most a row per key and ``COMPACT_EVERY`` batches.
    """
    known = [n for n in _folders(spark, f"{path}/{SNAPSHOTS}", UPTO, complete=True) if upto is None or n < upto]
    batches = [n for n in _folders(spark, path, BATCH) if (not known or n > known[-1]) and (upto is None or n <= upto)]
    numbered, parts = f"{schema}, {BATCH} BIGINT", []
    if known:
        snapshot = spark.read.schema(schema).parquet(f"{path}/{SNAPSHOTS}/{UPTO}={known[-1]}")
        if not batches:  # it has one row per key
            return snapshot
        parts.append(snapshot.withColumn(BATCH, F.lit(known[-1]).cast("bigint")))
    if batches:
        reader = spark.read.schema(numbered).option("basePath", path)
        parts.append(reader.parquet(*[f"{path}/{BATCH}={n}" for n in batches]))
    rows = reduce(DataFrame.unionByName, parts or [spark.createDataFrame([], numbered)])
    # column by column: numbers are then aggregated by hash, a struct only by sorting
    return rows.groupBy(*keys).agg(*[F.max_by(c, BATCH).alias(c) for c in rows.columns if c not in (*keys, BATCH)])


def appended(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows written in ``append`` mode."""
    return spark.read.schema(schema).parquet(path).drop(BATCH)
