"""Time-blocking of hot keys, shared by every per-key running operator.

A window partitioned by a key alone puts the whole key into one task. Here a
heavy-hitter sketch finds the keys that hold too many rows, and the time line of
each of them is cut into blocks of about equal row count. Windows then run per
(key, block), and each operator adds one *carry* row per block holding what the
earlier blocks of the key add up to. All other keys stay in block 0.

The sketch, and for hot keys the layout of their blocks from a sample of their times, are made
before the main plan is built, so both halves of that plan see one fixed layout. Where a sketch of bounded size
cannot name all keys above the limit, they are counted. The layout only balances work: results do not depend on it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranges import MAX_RANGES, lay_out, levels, split
from tidemark.operators.small import hint_if_small
from tidemark.session import materialise

BLOCK = "_block"
BEFORE_ALL = -(1 << 62)  # sorts ahead of every instant
SKETCH_FAN_IN = 256


@dataclass(frozen=True)
class HotKeys:
    """A key with more than ``rows_per_block`` rows is hot, and cut into blocks of about as many.

    Up to ``max_hot`` hot keys come from a sketch; ranges of blocks are cut into at most ``max_hot`` parts at a time.
    """

    rows_per_block: int = 2_000_000
    max_hot: int = MAX_RANGES
    sample_per_block: int = 16

    def __post_init__(self):
        if not 2 <= self.max_hot <= MAX_RANGES or self.rows_per_block < 1:
            raise ValueError(f"max_hot must lie in 2..{MAX_RANGES}, rows_per_block above 0")


@dataclass(frozen=True)
class Blocked:
    """``rows`` is the whole input with its block; ``hot`` the rows of hot keys only, None if there are none.

    ``origin`` is the earliest instant of the input, ``latest`` the last one.
    """

    rows: DataFrame
    hot: DataFrame | None
    origin: int
    latest: int

    def with_carry(self, carried: DataFrame | None) -> DataFrame:
        return self.rows if carried is None else self.rows.unionByName(carried, allowMissingColumns=True)


def split_hot_keys(rows: DataFrame, keys: list[str], us: str, policy: HotKeys) -> Blocked:
    hashed = rows.withColumn("_key_hash", F.xxhash64(*keys))
    tracked = F.lit(4 * policy.max_hot)
    # one sketch per task would be too much for the last merge: merge in two steps
    seen = (
        hashed.groupBy((F.spark_partition_id() % SKETCH_FAN_IN).alias("_part"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(us).alias("lo"),
            F.max(us).alias("hi"),
            F.call_function("approx_top_k_accumulate", "_key_hash", tracked).alias("sketch"),
        )
        .groupBy(F.lit("all"))  # no row at all for empty input
        .agg(
            F.sum("n").alias("n"),
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.call_function("approx_top_k_combine", "sketch", tracked).alias("sketch"),
        )
        .select("n", "lo", "hi", F.call_function("approx_top_k_estimate", "sketch", F.lit(policy.max_hot)).alias("top"))
        .first()
    )
    n, origin, latest, top = (seen["n"], seen["lo"] or 0, seen["hi"] or 0, seen["top"]) if seen else (0, 0, 0, [])
    spark, limit = rows.sparkSession, policy.rows_per_block
    if n <= limit * policy.max_hot:
        # a sketch that tracks 4 * max_hot keys holds every key with more than one in max_hot rows
        parts = [(item["item"], -int(-item["count"] // limit)) for item in top if item["count"] > limit]
        sizes = spark.createDataFrame(parts, "_key_hash BIGINT, _left BIGINT") if parts else None
    else:
        counted = hashed.groupBy("_key_hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
        sizes = materialise(counted.select("_key_hash", F.ceil(F.col("n") / limit).alias("_left")), "hot")
    most = sizes.agg(F.max("_left")).first()[0] if sizes else None
    if not most:
        return Blocked(rows.withColumn(BLOCK, F.lit(0).cast("bigint")), None, origin, latest)

    listed = hint_if_small(sizes, "hot")
    drawn = (
        hashed.select("_key_hash", us)
        .join(listed, "_key_hash")
        .where((F.rand(0) < policy.sample_per_block / limit) & F.col(us).isNotNull())
    )
    layouts = lay_out(materialise(drawn, "times"), ["_key_hash"], us, levels(most, policy.max_hot), policy.sample_per_block, policy.max_hot)
    hot = hashed.join(listed.select("_key_hash"), "_key_hash")

    def blocked(part: DataFrame) -> DataFrame:
        return split(part, layouts, ["_key_hash"], us, policy.max_hot, BLOCK).drop("_key_hash")

    return Blocked(blocked(hashed), blocked(hot), origin, latest)
