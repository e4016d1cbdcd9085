"""Point-in-time join: for each left row, the newest right row of its key that was already visible."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import gap_micros, micros
from tidemark.operators.hotkeys import BEFORE_ALL, BLOCK, HotKeys, split_hot_keys


def asof_join(
    left: DataFrame,
    right: DataFrame,
    *,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    columns: Sequence[str],
    right_id: str,
    gap: timedelta = timedelta(0),
    tolerance: timedelta | None = None,
    policy: HotKeys = HotKeys(),
) -> DataFrame:
    """``left`` plus ``columns`` of the matched right row, null where none is visible.

    A right row is visible iff its time + gap <= the left time; ``tolerance``
    further asks that it be no older than that before the moment of the read. Ties
    in time go to the larger ``right_id``. A null key matches nothing.
    """
    keys = [f"_by{i}" for i in range(len(by))]
    seen = right.dropna(subset=list(by)).select(
        *[F.col(b).alias(k) for b, k in zip(by, keys)],
        micros(right_time).alias("_us"),
        F.col(right_id).alias("_tie"),
        F.struct(*columns).alias("_match"),
    )
    reads = left.select(
        *[F.col(b).alias(k) for b, k in zip(by, keys)],
        (micros(left_time) - gap_micros(gap)).alias("_us"),
        F.struct(*left.columns).alias("_row"),
    )
    blocked = split_hot_keys(seen.unionByName(reads, allowMissingColumns=True), keys, "_us", policy)

    hit = "CASE WHEN _match IS NOT NULL THEN struct(_us AS at, _tie AS tie, _match AS row) END"
    carried = blocked.hot and _carry(blocked.hot, keys, hit)
    so_far = f"OVER (PARTITION BY {', '.join(keys)}, {BLOCK} ORDER BY _us, _row IS NOT NULL, _tie ROWS UNBOUNDED PRECEDING)"
    fresh = "true" if tolerance is None else f"_last.at >= _us - {gap_micros(tolerance)}"
    return (
        replace(blocked, rows=blocked.rows.withColumn("_hit", F.expr(hit)))
        .with_carry(carried)
        .selectExpr("_row", "_us", f"last(_hit) IGNORE NULLS {so_far} AS _last")
        .where("_row IS NOT NULL")
        .selectExpr("_row.*", *[f"CASE WHEN {fresh} THEN _last.row.`{c}` END AS `{c}`" for c in columns])
    )


def _carry(hot: DataFrame, keys: list[str], hit: str) -> DataFrame:
    """Per block of a hot key the newest row of its earlier blocks."""
    earlier = f"OVER (PARTITION BY {', '.join(keys)} ORDER BY {BLOCK} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    newest = f"max_by({hit}, CASE WHEN _match IS NOT NULL THEN struct(_us, _tie) END) AS _hit"
    per_block = hot.groupBy(*keys, BLOCK).agg(F.expr(newest))
    return per_block.selectExpr(*keys, BLOCK, f"{BEFORE_ALL} AS _us", f"last(_hit) IGNORE NULLS {earlier} AS _hit")
