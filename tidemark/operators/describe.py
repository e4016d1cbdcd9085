"""Descriptive statistics: per-label summaries, histograms, conditional means, coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.running import Ranges, exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)


def describe_by(rows: DataFrame, label: str, columns: Sequence[str], ranges: Ranges = Ranges()) -> DataFrame:
    """One row per label and column: count, mean, std, min, quartiles, max. Null values are left out; a null label is a label."""
    long = rows.select(label, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [label], list(columns), "column", "value"
    )
    keys = [label, "column"]
    summary = long.groupBy(*keys).agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = exact_quantiles(long, "value", QUARTILES, keys, ranges).withColumnsRenamed(
        {"q0": "p25", "q1": "p50", "q2": "p75"}
    )
    quartiles = quartiles.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return summary.join(quartiles, same, "left").drop(*[f"_{k}" for k in keys])


def label_balance(rows: DataFrame, label: str) -> DataFrame:
    """Positives, negatives, and how many whole negatives there are per positive."""
    positives, negatives = F.count_if(F.col(label) == 1), F.count_if(F.col(label) == 0)
    counts = rows.agg(positives.alias("positives"), negatives.alias("negatives"))
    return counts.withColumn("negatives_per_positive", F.expr("negatives DIV nullif(positives, 0)"))


def histogram_fixed(rows: DataFrame, column: str, width: float) -> DataFrame:
    """(bin start, count) with bins of fixed width; nulls are left out."""
    start = (F.floor(F.col(column) / width) * width).alias("bin")
    return rows.where(F.col(column).isNotNull()).groupBy(start).agg(F.count(F.lit(1)).alias("count"))


def histogram_equal(rows: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """(bin number from 1, count) over ``bins`` equal widths from minimum to maximum; the maximum joins the last bin."""
    edge = rows.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi"))).scalar()
    lo, hi = edge.getField("lo"), edge.getField("hi")
    place = F.floor((F.col(column) - lo) * bins / F.nullif(hi - lo, F.lit(0.0)))
    number = F.least(F.coalesce(place, F.lit(0)) + 1, F.lit(bins)).alias("bin")
    return rows.where(F.col(column).isNotNull()).groupBy(number).agg(F.count(F.lit(1)).alias("count"))


def clip(rows: DataFrame, upper: Mapping[str, float]) -> DataFrame:
    """Rows within every upper bound; a null fails its bound."""
    for column, bound in upper.items():
        rows = rows.where(F.col(column) <= bound)
    return rows


def conditional_means(rows: DataFrame, means: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row; each column is the mean of a SQL expression over the rows where a SQL condition holds."""
    return rows.agg(
        *[F.expr(f"avg(CASE WHEN {condition} THEN CAST({value} AS DOUBLE) END)").alias(name)
          for name, (value, condition) in means.items()]
    )


def coverage(rows: DataFrame, shares: Mapping[str, tuple[str, str]]) -> DataFrame:
    """One row; each column is the share of rows under a condition where a predicate holds.

    A predicate that is null counts as true, as comparing a missing value with
    ``!=`` does in the data frames these shares come from. Use ``coalesce`` for
    predicates where missing means false.
    """
    return rows.agg(
        *[
            F.expr(f"avg(CASE WHEN {condition} THEN CASE WHEN coalesce({predicate}, true) THEN 1D ELSE 0D END END)")
            .alias(name)
            for name, (predicate, condition) in shares.items()
        ]
    )


def argmax_row(rows: DataFrame, measure: str, default: float, tie: str) -> DataFrame:
    """The row with the largest measure, null counting as ``default``; ties go to the smallest ``tie``."""
    best = F.struct(F.coalesce(F.col(measure), F.lit(default)), -F.col(tie))
    return rows.agg(F.max_by(F.struct(*rows.columns), best).alias("r")).select("r.*")
