"""Candidate-source rank counts and yield curves.

Everything is aggregated to (source, rank) first and written to the scratch
folder, so the source rows are read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import simplify_source, strict_bool
from tidemark.operators.running import running_totals
from tidemark.session import materialise

FLAGS = ("is_liked", "is_shared", "is_profile_opened", "is_downloaded", "is_followed")

CLIENT_EVENT = (
    "cnt STRING, cg_ranks STRING, isLiked STRING, isShared STRING, isProfileOpened STRING, "
    "isDownloaded STRING, isFollowed STRING, vplay98 BOOLEAN"
)
CANDIDATE = "cnt STRING, cg_ranks STRING"
FAIL = {"mode": "FAILFAST"}


def _ranks(lines: DataFrame, schema: str) -> DataFrame:
    """Parsed lines, one row per (source, position) of the nested map."""
    row = lines.select(F.from_json("value", schema, FAIL).alias("e")).select("e.*")
    nested = F.from_json("cg_ranks", "MAP<STRING, STRING>", FAIL)
    return row.select("*", F.explode(nested).alias("source", "at")).select(
        "*",
        F.col("cnt").cast("bigint").alias("n"),
        F.col("at").cast("int").alias("pos"),
        simplify_source(F.col("source")).alias("cg_rank"),
    )


def client_event_ranks(lines: DataFrame) -> DataFrame:
    """Summed counts by source, position, the five reactions and long play."""
    flags = ("isLiked", "isShared", "isProfileOpened", "isDownloaded", "isFollowed")
    rows = _ranks(lines, CLIENT_EVENT).select(
        "n", "pos", "cg_rank", "vplay98", *[strict_bool(F.col(f)).alias(name) for f, name in zip(flags, FLAGS)]
    )
    return rows.groupBy("pos", "cg_rank", *FLAGS, "vplay98").agg(F.sum("n").alias("cnt"))


def candidate_ranks(lines: DataFrame) -> DataFrame:
    """Summed counts by source and position."""
    return _ranks(lines, CANDIDATE).groupBy("pos", "cg_rank").agg(F.sum("n").alias("cnt"))


def source_stats(counts: DataFrame) -> DataFrame:
    """Per source: deepest position, total, best and final running count per slot."""
    per_pos = counts.groupBy("cg_rank", "pos").agg(F.sum("cnt").alias("cnt"))
    stats = (
        running_totals(per_pos, "pos", ["cnt"], by=["cg_rank"])
        .withColumn("ratio", F.try_divide("cum_cnt", F.col("pos") + 1))
        .groupBy("cg_rank")
        .agg(
            F.max("pos").alias("max_pos"),
            F.sum("cnt").alias("total_sum"),
            F.max("ratio").alias("max_cumsum_ratio"),
            F.max_by("ratio", "pos").alias("last_cumsum_ratio"),
        )
    )
    total = stats.agg(F.sum("total_sum")).scalar()
    return stats.withColumn("normalized_cumsum_ratio", F.try_divide("last_cumsum_ratio", total))


def source_totals(counts: DataFrame) -> DataFrame:
    """Total count and deepest position per source."""
    return counts.groupBy("cg_rank").agg(F.sum("cnt").alias("cnt"), F.max("pos").alias("max_pos"))


def without_slots(rows: DataFrame, name: str, slots: Sequence[str]) -> DataFrame:
    """Simplified names, minus the fixed-slot sources; an unnamed source stays."""
    rows = rows.withColumn(name, simplify_source(F.col(name), merge_latest_view=False))
    return rows.where(F.col(name).isNull() | ~F.col(name).isin(*slots)) if slots else rows


def per_rank(rows: DataFrame) -> DataFrame:
    """(cg_name, cg_rank, cnt) rows summed up and written once."""
    return materialise(rows.groupBy("cg_name", "cg_rank").agg(F.sum("cnt").alias("cnt")), "ranks")


def per_rank_pair(rows: DataFrame, front: Column | str) -> tuple[DataFrame, DataFrame]:
    """``per_rank`` of all rows and of those that meet ``front``, from one grouping that is written once."""
    front = F.expr(front) if isinstance(front, str) else front
    both = rows.groupBy("cg_name", "cg_rank").agg(
        F.sum("cnt").alias("cnt"), F.sum(F.when(front, F.col("cnt"))).alias("_sum"), F.count_if(front).alias("_rows")
    )
    both = materialise(both, "ranks")
    return both.select("cg_name", "cg_rank", "cnt"), both.where("_rows > 0").select("cg_name", "cg_rank", F.col("_sum").alias("cnt"))


def overall_yield(pool: DataFrame, front: DataFrame) -> DataFrame:
    """Per source, from ``per_rank`` counts of the pool and of front events: shares and events per slot."""
    pools = pool.groupBy("cg_name").agg(F.sum("cnt").alias("cg_pool_cnt"))
    fronts = front.groupBy("cg_name").agg(F.sum("cnt").alias("front_events_cnt"))
    per_slot = F.try_divide("front_events_cnt", "cg_pool_cnt")
    both = fronts.join(pools, "cg_name", "full").withColumn("front_event_per_cg_slot", per_slot)
    return both.select(
        "*",
        F.try_divide("front_events_cnt", front.agg(F.sum("cnt")).scalar()).alias("front_events_share"),
        F.try_divide("cg_pool_cnt", pool.agg(F.sum("cnt")).scalar()).alias("cg_pool_share"),
        F.try_divide("front_event_per_cg_slot", both.agg(F.max("front_event_per_cg_slot")).scalar()).alias(
            "front_event_per_cg_slot_normalized"
        ),
    )


def yield_curve(pool: DataFrame, front: DataFrame) -> DataFrame:
    """Per source and rank, from ``per_rank`` counts: running events against running pool slots, normalised by the best."""

    def running(counts: DataFrame, count: str, cumsum: str) -> DataFrame:
        totals = running_totals(counts, "cg_rank", ["cnt"], by=["cg_name"], written=True)
        return totals.selectExpr("cg_name", "cg_rank", f"cnt AS {count}", f"cum_cnt AS {cumsum}")

    pools = running(pool, "cg_pool_cnt", "cg_pool_cumsum")
    fronts = running(front, "front_events_cnt", "front_events_cumsum")
    both = fronts.join(pools, ["cg_name", "cg_rank"]).withColumn(
        "front_event_per_cg_slot", F.try_divide("front_events_cumsum", "cg_pool_cumsum")
    )
    # the pool total counts joined rows only; the event total sums running sums
    totals = both.agg(
        F.struct(
            F.sum("cg_pool_cnt").alias("pool"),
            F.sum("front_events_cumsum").alias("events"),
            F.max("front_event_per_cg_slot").alias("best"),
        )
    ).scalar()
    return both.select(
        "*",
        F.try_divide("cg_pool_cumsum", totals.getField("pool")).alias("cg_pool_cumshare"),
        F.try_divide("front_events_cumsum", totals.getField("events")).alias("front_events_share"),
        F.try_divide("front_event_per_cg_slot", totals.getField("best")).alias("front_event_per_cg_slot_normalized"),
        F.try_divide("cg_pool_cumsum", F.col("cg_rank") + 1).alias("cg_pool_cumsum_per_pos"),
    )


def yield_summary(pool: DataFrame, front: DataFrame) -> DataFrame:
    """Overall yield next to the final point of each source's curve, the latter scaled to its maximum."""
    last = (
        yield_curve(pool, front)
        .groupBy("cg_name")
        .agg(F.max_by("front_event_per_cg_slot_normalized", "cg_rank").alias("last_front_event_per_cg_slot_normalized"))
    )
    both = materialise(overall_yield(pool, front).join(last, "cg_name"), "yields")
    best = both.agg(F.max("last_front_event_per_cg_slot_normalized")).scalar()
    return both.withColumn(
        "last_front_event_per_cg_slot_normalized", F.try_divide("last_front_event_per_cg_slot_normalized", best)
    )
