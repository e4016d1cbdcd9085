"""Running totals over a global order, and what rests on them: exact quantiles and dense indexes.

The input is one row per ordered value, already aggregated from the source rows.
It is written to the scratch folder once, so the source is read once however
often the rows are used below. A table of up to ``rows_per_range`` rows goes
through one plain window. A larger one would overload a single task: it is cut
into ranges of about equal row count, each range is summed, and every range
starts from a carry row holding the totals of the ranges before it. Those totals
are running totals themselves, over a row per range, and get the same treatment.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ranges import MAX_RANGES, lay_out, levels, split
from tidemark.session import materialise


@dataclass(frozen=True)
class Ranges:
    """How many rows a range should hold, and into how many parts a range is cut at a time."""

    rows_per_range: int = 1_000_000
    sample_per_range: int = 16
    fan: int = MAX_RANGES

    def __post_init__(self):
        if not 2 <= self.fan <= MAX_RANGES or self.rows_per_range < 1:
            raise ValueError(f"fan must lie in 2..{MAX_RANGES}, rows_per_range above 0")


def ranged(rows: DataFrame, n: int, order: str, ranges: Ranges) -> DataFrame:
    """``rows``, ``n`` of them, plus ``_range``: consecutive ranges by ``order`` of about ``rows_per_range`` rows."""
    parts = -(-n // ranges.rows_per_range)
    rate = min(1.0, parts * ranges.sample_per_range / n)
    drawn = rows.where(F.rand(0) < rate).select(order, F.lit(parts).cast("bigint").alias("_left"))
    # the sample has sample_per_range rows for each range, as a table of its own
    layouts = lay_out(materialise(drawn, "sample"), [], order, levels(parts, ranges.fan), ranges.sample_per_range, ranges.fan)
    return split(rows, layouts, [], order, ranges.fan, "_range")


def running_totals(
    rows: DataFrame,
    order: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    ranges: Ranges = Ranges(),
    written: bool = False,
) -> DataFrame:
    """``rows`` plus, for each of ``sums`` and per ``by`` group, ``cum_<c>`` and ``total_<c>``.

    ``cum_<c>`` is the total up to and including ``order``, ``total_<c>`` the whole
    group's. ``rows`` holds one row per (``by``, ``order``) value;
    ``written`` says that it is a stored table already.
    """
    if not written:
        rows = materialise(rows, "totals")
    n = rows.count()
    group = f"PARTITION BY {', '.join(by)} " if by else ""
    if n <= ranges.rows_per_range:
        upto = f"OVER ({group}ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        return rows.selectExpr(
            "*",
            *[f"sum({c}) {upto} AS cum_{c}" for c in sums],
            *[f"sum({c}) OVER ({group}) AS total_{c}" for c in sums],
        )
    cut = ranged(rows, n, order, ranges)
    per_range = cut.groupBy(*by, F.col("_range").alias("_at")).agg(*[F.sum(c).alias(c) for c in sums])
    wider = replace(ranges, rows_per_range=4 * ranges.rows_per_range)  # each step leaves at most about a quarter
    carried = running_totals(per_range, "_at", sums, by, wider).selectExpr(
        *by,
        "_at AS _range",
        "true AS _carry",
        *[f"cum_{c} - {c} AS {c}" for c in sums],
        *[f"total_{c}" for c in sums],
    )
    so_far = (
        f"OVER (PARTITION BY {', '.join([*by, '_range'])} ORDER BY _carry IS NULL, {order} "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    return (
        cut.unionByName(carried, allowMissingColumns=True)
        .selectExpr(
            *rows.columns,
            "_carry",
            *[f"sum({c}) {so_far} AS cum_{c}" for c in sums],
            *[f"first(total_{c}) {so_far} AS total_{c}" for c in sums],
        )
        .where("_carry IS NULL")
        .drop("_carry")
    )


def exact_quantiles(
    rows: DataFrame, value: str, probabilities: Sequence[float], by: Sequence[str] = (), ranges: Ranges = Ranges()
) -> DataFrame:
    """Per group the linearly interpolated quantiles of ``value`` as ``q0, q1, …``; nulls are left out."""
    group = list(by)
    counted = rows.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running_totals(counted, value, ["_n"], group, ranges)
    cells = []
    for i, p in enumerate(probabilities):
        at = f"((total__n - 1) * {p}D)"
        for side, rank in (("lo", f"floor({at})"), ("hi", f"ceil({at})")):
            hit = f"cum__n - _n <= {rank} AND {rank} < cum__n"
            cells.append(F.expr(f"max(CASE WHEN {hit} THEN {value} END) AS _{side}{i}"))
        cells.append(F.expr(f"max({at} - floor({at})) AS _w{i}"))
    return placed.groupBy(*group).agg(*cells).selectExpr(
        *group, *[f"_lo{i} + (_hi{i} - _lo{i}) * _w{i} AS q{i}" for i in range(len(probabilities))]
    )


def dense_index(ids: DataFrame, column: str, index: str, ranges: Ranges = Ranges()) -> DataFrame:
    """Distinct values of ``column`` numbered from 0 in sorted order; null gets no number."""
    distinct = ids.where(F.col(column).isNotNull()).select(column).distinct().withColumn("_one", F.lit(1))
    return running_totals(distinct, column, ["_one"], ranges=ranges).selectExpr(
        f"`{column}`", f"cum__one - 1 AS `{index}`"
    )
