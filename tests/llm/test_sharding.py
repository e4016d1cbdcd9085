from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import sharding
from tidemark.session import scratch_path


def shards(spark, docs, n=7, **more):
    return sharding.with_slots(sharding.write_shards(docs, scratch_path(spark, "shards"), n, "doc_id", "text", **more))


def test_all_rows_gapless_slots_small_buckets(spark, documents):
    rows = shards(spark, documents, bucket_bytes=20_000).select("record.*", "shard", "slot").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in documents.select("doc_id").collect())
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 7


def test_order_is_shuffled_and_repeatable(spark, documents):
    first = {r.record.doc_id: (r["shard"], r.slot) for r in shards(spark, documents, bucket_bytes=50_000).collect()}
    again = {r.record.doc_id: (r["shard"], r.slot) for r in shards(spark, documents, bucket_bytes=50_000).collect()}
    other = {r.record.doc_id: (r["shard"], r.slot) for r in shards(spark, documents, bucket_bytes=50_000, seed=5).collect()}
    assert first == again != other
    by_id = [slot for _, (shard, slot) in sorted(first.items()) if shard == 0]
    up = sum(a < b for a, b in zip(by_id, by_id[1:])) / (len(by_id) - 1)
    assert 0.3 < up < 0.7


def test_one_more_shard_takes_rows_only_into_itself(spark):
    rows = spark.range(20_000).select(
        sharding.shard_of("id", 40, 3).alias("a"), sharding.shard_of("id", 41, 3).alias("b")
    )
    moved = rows.where("a != b")
    assert moved.where("b != 40").count() == 0
    assert 300 < moved.count() < 700
    sizes = [r["count"] for r in rows.groupBy("a").count().collect()]
    assert len(sizes) == 40 and min(sizes) > 380 and max(sizes) < 620


def test_odd_rows(spark, odd):
    rows = shards(spark, odd).select("record.*").collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, odd.collect()))
    sizes = odd.select(sharding.record_size("text").alias("n"), F.octet_length("text").alias("b")).collect()
    assert all(r.n == (r.b or 0) + 16 for r in sizes)


def test_a_hot_key_does_not_fill_one_bucket(spark):
    hot = spark.range(3_000).select(F.lit(1).cast("long").alias("doc_id"), F.lit("x" * 100).alias("text"))
    written = sharding.write_shards(hot, scratch_path(spark, "shards"), 2, "doc_id", "text", bucket_bytes=10_000)
    sizes = [r["count"] for r in written.groupBy("shard", "_bucket").count().collect()]
    assert sum(sizes) == 3_000 and max(sizes) < 400


def test_no_rows(spark, odd):
    assert shards(spark, odd.where("false")).count() == 0
