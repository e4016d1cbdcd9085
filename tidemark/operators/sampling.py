"""Splits, exact-size samples and class weights. All draws are hashes of a row id, so reruns agree."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import HASH_BITS, portable_hash
from tidemark.operators.small import hint_if_small
from tidemark.session import materialise

BUCKET_BITS = 12
#: Rows that one task ranks at most.
RANKED_ROWS = 1_000_000


def date_split(rows: DataFrame, day: str, validation: date, gap: date) -> DataFrame:
    """``split``: ``val`` on one day, ``gap`` (to be left out) on another, else ``train``."""
    on = F.to_date(day)
    return rows.withColumn(
        "split", F.when(on == F.lit(validation), "val").when(on == F.lit(gap), "gap").otherwise("train")
    )


def temporal_split(rows: DataFrame, time: str, boundary: str) -> tuple[DataFrame, DataFrame]:
    """(before, from the boundary on)."""
    late = F.col(time) >= F.lit(boundary).cast("timestamp_ntz")
    return rows.where(~late), rows.where(late)


def timespent_label(minutes: Column) -> Column:
    """1 from a whole minute spent on, else 0."""
    return F.when(minutes * 60 >= 60, 1).otherwise(0)


def _cut_bucket(hashed: DataFrame, quota: str, by: list[str], most: int) -> tuple[DataFrame, int]:
    """(by, _bucket, _rest, n) and the bits of a bucket: the bucket that holds each group's cut, and how far into it.

    Rows are counted per bucket of the first hash bits. While a bucket that holds a cut has more than ``most`` rows, its
    rows alone are counted again by the next bits; so no task ranks more rows, but for those of one hash.
    """
    group = f"PARTITION BY {', '.join(by)} " if by else ""
    inside, bits, wanted = hashed, BUCKET_BITS, quota
    while True:
        bucket = F.shiftright("_h", HASH_BITS - bits).alias("_bucket")
        rest = ["_wanted"] if bits > BUCKET_BITS else []
        counted = inside.groupBy(*by, *rest, bucket).agg(F.count(F.lit(1)).alias("n"))
        cut = (
            counted.selectExpr("*", f"sum(n) OVER ({group}ORDER BY _bucket) AS _upto", f"sum(n) OVER ({group}) AS total")
            .selectExpr(*by, "_bucket", "n", "_upto - n AS _before", f"least(total, CAST({wanted} AS BIGINT)) AS _quota")
            .where("_before < _quota AND _quota <= _before + n")
            .selectExpr(*by, "_bucket", "_quota - _before AS _rest", "n")
        )
        cut = materialise(cut, "cut")
        if bits == HASH_BITS or cut.where(F.col("n") > most).isEmpty():
            return cut, bits
        side = cut.select(*by, F.col("_bucket").alias("_above"), F.col("_rest").alias("_wanted"))
        above = hashed.withColumn("_above", F.shiftright("_h", HASH_BITS - bits))
        inside = above.join(hint_if_small(side, "cut"), [*by, "_above"])
        bits, wanted = min(HASH_BITS, bits + BUCKET_BITS), "_wanted"


def _exact_cut(rows: DataFrame, key: str, seed: int, quota: str, by: list[str], most: int) -> DataFrame:
    """Per group the (hash, key) of its ``quota``-th smallest row; ``quota`` is SQL over the group size ``total``.

    Rows are counted per hash bucket first; only the one bucket that holds the cut is ranked.
    """
    hashed = rows.select(*by, F.col(key).alias("_key"), portable_hash(F.col(key), seed).alias("_h"))
    cut, bits = _cut_bucket(hashed, quota, by, most)
    ranked = f"row_number() OVER (PARTITION BY {', '.join([*by, '_bucket'])} ORDER BY _h, _key)"
    return (
        hashed.withColumn("_bucket", F.shiftright("_h", HASH_BITS - bits))
        .join(hint_if_small(cut.drop("n"), "cut") if by else F.broadcast(cut.drop("n")), [*by, "_bucket"])
        .selectExpr("*", f"{ranked} AS _rank")
        .where("_rank = _rest")
        .selectExpr(*by, "struct(_h, _key) AS _cut")
    )


def exact_sample(
    rows: DataFrame,
    key: str,
    *,
    fraction: float | None = None,
    n: int | None = None,
    by: str | None = None,
    seed: int = 42,
    flag: str = "in_sample",
    ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """``rows`` plus a flag that marks exactly ceil(fraction * size) or ``n`` rows, without replacement.

    With ``by`` the count is met in every class. ``key`` identifies a row; rows whose key or class is null
    are never in the sample and do not count. The main rows are only compared with the cut: they are
    neither sorted nor shuffled.
    """
    if (fraction is None) == (n is None):
        raise ValueError("give either fraction or n")
    quota = f"ceil(total * {fraction}BD)" if n is None else str(n)
    mark = F.struct(portable_hash(F.col(key), seed).alias("_h"), F.col(key).alias("_key"))
    whole = rows.dropna(subset=[key, *([by] if by else [])])

    def chosen(cut: Column) -> Column:
        return F.coalesce(F.col(key).isNotNull() & (mark <= cut), F.lit(False))

    if by is None:
        return rows.withColumn(flag, chosen(_exact_cut(whole, key, seed, quota, [], ranked_rows).scalar()))
    cuts = hint_if_small(_exact_cut(whole, key, seed, quota, [by], ranked_rows), "cuts")
    return rows.join(cuts, by, "left").withColumn(flag, chosen(F.col("_cut"))).drop("_cut")


def downsample_negatives(rows: DataFrame, label: str, key: str, n: int, seed: int = 42) -> DataFrame:
    """Every positive row and exactly ``n`` negatives (all of them if there are fewer)."""
    negatives = exact_sample(rows.where(F.col(label) == 0), key, n=n, seed=seed).where("in_sample").drop("in_sample")
    return rows.where(F.col(label) == 1).unionByName(negatives)


def shuffled(rows: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Rows in a random order that a rerun repeats."""
    return rows.orderBy(portable_hash(F.col(key), seed), key)


def balanced_weights(rows: DataFrame, label: str, weight: str = "weight") -> DataFrame:
    """``rows`` plus the weight n / (classes * size of the row's class); rows without a label count nowhere and get null."""
    sizes = rows.dropna(subset=[label]).groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    weights = hint_if_small(
        sizes.selectExpr(f"`{label}`", f"sum(_n) OVER () / (count(*) OVER () * _n) AS `{weight}`"), "weights"
    )
    return rows.join(weights, label, "left")
