"""Sharding by a two-pass external shuffle.

Pass one scatters the records with seeded hashes into buckets that fit into memory; pass two
shuffles every bucket (Fisher-Yates) and writes it. Records go to buckets uniformly and are put
in uniformly random order there, so each shard holds a uniformly random order of its records.

The shard of a record follows from its key and the number of shards alone: of all shards, it
takes the one whose seeded hash with the key is the highest. A further shard therefore takes
records only into itself. Buckets are parts of shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROW_BYTES = 16


def record_size(text: str | Column) -> Column:
    """UTF-8 bytes of the text (none for a null) plus a fixed 16."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.octet_length(column), F.lit(0)).cast("long") + F.lit(ROW_BYTES)


def shard_of(key: str | Column, shards: int, seed: int) -> Column:
    """The shard, 0 to ``shards`` - 1, with the highest seeded hash of the key; null is a key like any other."""
    ranked = [F.struct(F.xxhash64(F.lit(seed), F.lit(i), key).alias("h"), F.lit(i).alias("i")) for i in range(shards)]
    return F.greatest(*ranked).getField("i") if shards > 1 else F.lit(0)


def _shuffled(seed: int):
    """Put each partition, which is one bucket, in Fisher-Yates order and number its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        # rows reach a bucket in any order: a fixed one first makes the result repeatable
        order = np.argsort(table.column("_order").to_numpy(), kind="stable")
        bucket = table.column("_bucket")[0].as_py()
        np.random.default_rng([seed, bucket]).shuffle(order)
        table = table.take(pa.array(order)).drop_columns(["_order"])
        table = table.append_column("position", pa.array(np.arange(len(order), dtype=np.int64)))
        yield from table.to_batches(max_chunksize=4096)

    return run


def write_shards(
    df: DataFrame,
    path: str,
    shards: int,
    key: str,
    text: str,
    seed: int = 1,
    bucket_bytes: int = 24 << 20,
) -> DataFrame:
    """Write all rows of ``df`` below ``path``, one folder a shard, one file a bucket, and read them.

    Each row is one struct column ``record``, so no column name of the input can clash with
    ``shard``, ``_bucket`` and ``position``. Null keys are one key; null and empty texts are
    records of 16 bytes; repeated rows are kept, all of them. A bucket holds about ``bucket_bytes``
    whatever the size of the input, as a hash of the row's number in its input split takes part
    in the choice of a bucket: neither a hot key nor copies fill one. ``df`` must give its rows in
    the same splits when read again, as files do.
    """
    total = df.agg(F.sum(record_size(text))).first()[0] or 0
    parts = max(1, -(-total // (shards * bucket_bytes)))
    salted = df.select(
        F.struct(*[df[c] for c in df.columns]).alias("record"),
        shard_of(df[key], shards, seed).alias("shard"),
        F.xxhash64(F.lit(seed), df[key], df[text], F.monotonically_increasing_id()).alias("_order"),
    )
    bucket = F.col("shard") * F.lit(parts) + F.pmod(F.xxhash64(F.lit(seed + 1), "_order"), F.lit(parts)).cast("int")
    scattered = salted.withColumn("_bucket", bucket).repartitionById(shards * parts, F.col("_bucket").cast("int"))
    schema = scattered.drop("_order").schema.add("position", "long")
    scattered.mapInArrow(_shuffled(seed), schema).write.partitionBy("shard").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def with_slots(written: DataFrame) -> DataFrame:
    """The written rows with ``shard`` and ``slot``, their gapless place in the shard.

    The buckets of a shard follow one another; their row counts, one row a bucket, give the offsets.
    """
    counts = written.groupBy("shard", "_bucket").count()
    before = F.sum("count").over(Window.partitionBy("shard").orderBy("_bucket")) - F.col("count")
    offsets = counts.select(F.col("shard").alias("s"), F.col("_bucket").alias("b"), before.alias("before"))
    same = (F.col("shard") == F.col("s")) & (F.col("_bucket") == F.col("b"))
    # one row a bucket of megabytes: small beside the data by construction
    return written.join(F.broadcast(offsets), same).select(
        "record", "shard", (F.col("before") + F.col("position")).alias("slot")
    )
