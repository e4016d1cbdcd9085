"""Delayed interaction histories: what a member had done, as visible at each row.

Every row is both a read and, one gap later, an interaction that extends the
member's positive (label > 0) or negative history. A history is bounded: once it
passes 2 * max_size items the oldest max_size are dropped, so after n items its
length is

    n                                  while n <= 2 * max_size
    max_size + 1 + (n - 2*max_size - 1) mod max_size   afterwards.

No task ever holds more than 2 * max_size items of a history, and one shuffle on
(member, block) serves both polarities.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import gap_micros, micros
from tidemark.operators.hotkeys import BEFORE_ALL, BLOCK, HotKeys, split_hot_keys

# Fixed values of the standard history
STANDARD_GAP = timedelta(hours=1)
STANDARD_SIZE = 32

CARRY, INTERACTION, READ = -1, 0, 1


def _length(n: str, size: int, mode: str) -> str:
    if mode == "last_k":
        return f"least({n}, {size})"
    if mode == "sawtooth":
        return f"CASE WHEN {n} <= {2 * size} THEN {n} ELSE {size + 1} + ({n} - {2 * size + 1}) % {size} END"
    raise ValueError(f"unknown history mode {mode}")


def _last(items: str, n: str) -> str:
    return f"slice({items}, greatest(size({items}) - CAST({n} AS INT), 0) + 1, CAST({n} AS INT))"


def delayed_history(
    rows: DataFrame,
    *,
    member: str,
    item: str,
    label: str,
    time: str,
    row_id: str,
    gap: timedelta = STANDARD_GAP,
    start: datetime | None = None,
    max_size: int = STANDARD_SIZE,
    mode: str = "sawtooth",
    positives: str = "positives_history",
    negatives: str = "negatives_history",
    policy: HotKeys = HotKeys(),
) -> DataFrame:
    """``rows`` at or after ``start`` plus two array columns, oldest item first.

    An interaction is visible to a read iff its time + gap <= the read's time;
    interactions at the same instant are ordered by ``row_id``.
    """
    keep = 2 * max_size
    passed = rows.columns
    timed = rows.withColumns({"_us": micros(time), "_member": F.col(member)})
    interactions = timed.selectExpr(
        "_member",
        f"_us + {gap_micros(gap)} AS _us",
        f"{INTERACTION} AS _kind",
        f"`{row_id}` AS _tie",
        f"coalesce(`{label}` > 0, false) AS _positive",
        f"`{item}` AS _item",
    )
    reads = timed if start is None else timed.where(F.col(time) >= F.lit(start))
    reads = reads.select(
        "_member", "_us", F.lit(READ).alias("_kind"), F.col(row_id).alias("_tie"), F.struct(*passed).alias("_row")
    )
    everything = interactions.unionByName(reads, allowMissingColumns=True)
    blocked = split_hot_keys(everything, ["_member"], "_us", policy)
    carried = blocked.hot and _carry(blocked.hot, keep)

    per_polarity = f"PARTITION BY _member, {BLOCK}, _positive ORDER BY _kind, _us, _tie"
    in_time = f"PARTITION BY _member, {BLOCK} ORDER BY _us, _kind, _tie"
    ranked = f"count(_item) OVER ({per_polarity} ROWS UNBOUNDED PRECEDING)"
    recent = f"collect_list(_item) OVER ({per_polarity} ROWS BETWEEN {keep - 1} PRECEDING AND CURRENT ROW)"
    visible = f"last(CASE WHEN {{}} THEN _history END) IGNORE NULLS OVER ({in_time})"
    everything = blocked.with_carry(carried).repartition("_member", BLOCK)
    if carried is None:
        listed = everything.selectExpr("*", f"{ranked} AS _n", f"{recent} AS _recent")
    else:
        # the carry row comes first in its window
        listed = everything.selectExpr(
            "*",
            f"{ranked} AS _rank",
            f"{recent} AS _recent",
            f"coalesce(first(_carried_n) OVER ({per_polarity} ROWS UNBOUNDED PRECEDING), 0L) AS _before",
            f"coalesce(first(_carried_tail) OVER ({per_polarity} ROWS UNBOUNDED PRECEDING), array()) AS _tail",
        ).withColumns(
            {
                "_n": F.expr("_before + _rank"),
                "_recent": F.expr(f"CASE WHEN _rank >= {keep} THEN _recent ELSE concat(_tail, _recent) END"),
            }
        )
    history = _last("_recent", _length("_n", max_size, mode))
    return (
        listed.withColumn("_history", F.expr(f"CASE WHEN _kind < {READ} THEN {history} END"))
        .selectExpr(
            "_kind",
            "_row",
            f"coalesce({visible.format('_positive')}, array()) AS `{positives}`",
            f"coalesce({visible.format('NOT _positive')}, array()) AS `{negatives}`",
        )
        .where(f"_kind = {READ}")
        .selectExpr("_row.*", f"`{positives}`", f"`{negatives}`")
    )


def _carry(hot: DataFrame, keep: int) -> DataFrame:
    """Per block and polarity of a hot member: how many items came before, and the last ``keep`` of them.

    The tail of a block reaches back over at most ``keep`` non-empty blocks, since
    each of those holds at least one item.
    """
    slot = ["_member", BLOCK, "_positive"]
    done = hot.where(F.col("_kind") == INTERACTION)
    newest = Window.partitionBy(*slot).orderBy(F.desc("_us"), F.desc("_tie"))
    tails = (
        done.withColumn("_back", F.row_number().over(newest))
        .where(F.col("_back") <= keep)
        .groupBy(*slot)
        .agg(F.sort_array(F.collect_list(F.struct("_us", "_tie", "_item"))).getField("_item").alias("_tail"))
    )
    counts = done.groupBy(*slot).agg(F.count(F.lit(1)).alias("_n"))
    by_block = f"PARTITION BY _member, _positive ORDER BY {BLOCK}"
    reached = f"flatten(collect_list(_tail) OVER ({by_block} ROWS BETWEEN {keep - 1} PRECEDING AND CURRENT ROW))"
    ends = (
        counts.join(tails, slot)
        .selectExpr(*slot, f"sum(_n) OVER ({by_block} ROWS UNBOUNDED PRECEDING) AS _n", f"{reached} AS _reached")
        .selectExpr(*slot, "_n", f"{_last('_reached', str(keep))} AS _tail")
    )
    slots = hot.select("_member", BLOCK).distinct().selectExpr("*", "explode(array(true, false)) AS _positive")
    earlier = f"OVER ({by_block} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return (
        slots.join(ends, slot, "left")
        .selectExpr(
            *slot,
            f"{BEFORE_ALL} AS _us",
            f"{CARRY} AS _kind",
            f"last(_n) IGNORE NULLS {earlier} AS _carried_n",
            f"last(_tail) IGNORE NULLS {earlier} AS _carried_tail",
        )
        .where("_carried_n IS NOT NULL")
    )
