"""Hashes. The md5 one can be recomputed by any SQL engine; xxhash64 stays inside Spark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_BITS = 32


def portable_hash(value: Column, seed: int | str = "") -> Column:
    """The first 32 bits of md5(seed:value) as a BIGINT; without a seed md5(value)."""
    text = value.cast("string")
    salted = text if seed == "" else F.concat(F.lit(f"{seed}:"), text)
    return F.conv(F.substring(F.md5(salted), 1, 8), 16, 10).cast("bigint")


def hash_bucket(value: Column, buckets: int) -> Column:
    """Bucket of a value in 0 … buckets-1."""
    return F.pmod(portable_hash(value), F.lit(buckets))


def shard(value: Column, index: int, shards: int) -> Column:
    """Whether a row belongs to shard ``index`` of ``shards``; the shards partition the rows."""
    return F.pmod(portable_hash(value) + index, F.lit(shards)) == 0
