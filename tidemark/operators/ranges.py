"""Consecutive ranges of about equal row count, laid out from a sample, in as many levels as the data need.

A level cuts a range into at most ``fan`` parts, whose bounds are one sorted array; a table that needs more ranges has
its ranges cut again. So no array of bounds grows with the data, and neither does a range. Layouts only balance
work: results do not depend on them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

STEPS = 12
MAX_RANGES = 1 << STEPS
#: Ranges whose bounds, of at most ``MAX_RANGES`` values each, are small enough to broadcast.
BROADCAST_RANGES = 1_000


def bisect(rows: DataFrame, value: str, bounds: str, out: str) -> DataFrame:
    """``rows`` plus ``out``: how many of the sorted array ``bounds`` are at or below ``value``; 0 without bounds.

    ``bounds`` has fewer than ``MAX_RANGES`` elements.
    """
    found = rows.withColumn(out, F.lit(0))
    for step in (1 << k for k in reversed(range(STEPS))):
        further = f"`{out}` + CASE WHEN get(`{bounds}`, `{out}` + {step - 1}) <= `{value}` THEN {step} ELSE 0 END"
        found = found.withColumn(out, F.expr(further))
    return found


def levels(parts: int, fan: int) -> int:
    """How often ranges must be cut into ``fan`` to get ``parts`` of them."""
    found = 1
    while fan**found < parts:
        found += 1
    return found


def lay_out(sample: DataFrame, group: Sequence[str], value: str, depth: int, per_range: int, fan: int = MAX_RANGES) -> list[DataFrame]:
    """The layout (group, _range, _bounds) of each level, from the top, written down.

    ``sample`` holds group, value and ``_left``: into how many ranges the group is to be cut, of which the sample has about
    ``per_range`` rows each. Of a range with more parts below it, as many rows as ``fan`` parts need make its bounds.
    """
    found = []
    rows = sample.withColumn("_range", F.lit(0).cast("bigint"))
    for level in range(depth):
        drawn = F.rand(level) * F.col("_left") < fan  # the sample is written: its rows are drawn alike each time
        cut = (
            rows.where((F.col("_left") > 1) & drawn)
            .groupBy(*group, "_range")
            .agg(F.array_sort(F.collect_list(value)).alias("s"), F.least(F.max("_left"), F.lit(fan)).alias("kids"))
        )
        bounds = "transform(sequence(1, CAST(kids AS INT) - 1), i -> get(s, CAST(CAST(size(s) AS BIGINT) * i DIV kids AS INT)))"
        found.append(materialise(cut.selectExpr(*group, "_range", f"{bounds} AS _bounds"), "layout"))
        start = rows if level else rows.drop("_range")
        rows = split(start, found[-1:], group, value, fan, "_range").withColumn(
            "_left", F.ceil(F.col("_left") / F.least(F.col("_left"), F.lit(fan)))
        )
    return found


def split(rows: DataFrame, layouts: Sequence[DataFrame], group: Sequence[str], value: str, fan: int, out: str) -> DataFrame:
    """``rows`` plus ``out``, the number of the range of their group that ``value`` lies in; ranges are numbered in order.

    With ``out`` in ``rows`` the ranges of that number are cut further. Small layouts are broadcast; others are left to the
    join planner, which splits what a large range brings together.
    """
    whole = not group and out not in rows.columns  # nothing is cut yet: the first layout is one row
    if out not in rows.columns:
        rows = rows.withColumn(out, F.lit(0).cast("bigint"))
    for level, layout in enumerate(layouts):
        side = layout.withColumnRenamed("_range", out)
        if whole and not level:
            joined = rows.withColumn("_bounds", layout.select("_bounds").scalar())
        else:
            small = layout.limit(BROADCAST_RANGES + 1).count() <= BROADCAST_RANGES
            joined = rows.join(F.broadcast(side) if small else side, [*group, out], "left")
        rows = bisect(joined, value, "_bounds", "_part")
        rows = rows.withColumn(out, F.col(out) * fan + F.col("_part")).drop("_bounds", "_part")
    return rows
