"""Embedding joins, pooling and factor tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.vectors import dot, or_zeros
from tidemark.operators.small import hint_if_small
from tidemark.session import materialise

#: Of pooled sequences: slots in which row ids are weighed, items that a task sums.
SLOTS, ITEMS_PER_PART = 1024, 1 << 19


def latest_per_id(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per id, the one with the largest ``order``: joins to it cannot multiply rows."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("_r")).select("_r.*")


def first_per_id(rows: DataFrame, key: str, order: str) -> DataFrame:
    """One row per id, the one with the smallest ``order``."""
    return rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), order).alias("_r")).select("_r.*")


def join_embeddings(
    rows: DataFrame, embeddings: DataFrame, *, row_key: str, key: str, vector: str, dim: int, name: str
) -> DataFrame:
    """``rows`` plus the vector of ``row_key`` as ``name``; zeros where there is none. Ids must be unique."""
    side = embeddings.select(F.col(key).alias("_id"), F.col(vector).alias("_vector"))
    joined = rows.join(side, rows[row_key] == side["_id"], "left")
    return joined.withColumn(name, or_zeros(F.col("_vector"), dim)).drop("_id", "_vector")


def dot_feature(rows: DataFrame, left: str, right: str, name: str) -> DataFrame:
    return rows.withColumn(name, dot(F.col(left), F.col(right)))


def pretrained_indexes(rows: DataFrame, table: DataFrame, key: str, index: str, keep: Sequence[str] = ()) -> DataFrame:
    """Inner join to a table of known ids whose ``index`` counts from 1; rows with unseen ids drop out.

    The table's columns ``keep`` come along, so that its vectors and biases need no join of their own.
    """
    return rows.join(table.select(key, (F.col(index) - 1).alias(index), *keep), key)


def pool_sequence(
    rows: DataFrame, embeddings: DataFrame, *, row_id: str, sequence: str, key: str, vector: str, dim: int, name: str
) -> DataFrame:
    """(row_id, sum of the vectors of the sequence's ids); ids without a vector add nothing.

    An id that a sequence repeats is joined once, with its count: counting needs no shuffle. Rows are dealt by their id into parts
    that do not grow with the table, and are summed where they lie if the vectors that they name are few enough to go to
    each part. Row ids that share a slot with very many items are dealt row by row; their sums are added up.
    """
    held = materialise(rows.select(F.col(row_id).alias("_row"), F.col(sequence).alias("_ids")), "sequences")
    items = F.greatest(F.coalesce(F.size("_ids"), F.lit(0)), F.lit(1)).cast("bigint")
    slot = F.pmod(F.xxhash64("_row"), F.lit(SLOTS)).cast("int")
    sizes = dict(held.groupBy(slot).agg(F.sum(items)).collect())
    usual = 2 * sum(sizes.values()) // SLOTS + ITEMS_PER_PART
    crowded = {s: n for s, n in sizes.items() if n > usual}
    many = sum(crowded.values())
    named = held.select(F.explode(F.array_distinct("_ids")).alias("_named")).distinct()
    side = embeddings.select(F.col(key).alias("_id"), F.col(vector).alias("_vector"))
    side = hint_if_small(side.join(named, F.col("_id") == F.col("_named"), "leftsemi"), "named")
    counts = F.transform(
        F.array_distinct("_ids"), lambda x: F.struct(x.alias("_id"), F.size(F.filter("_ids", lambda y: y.eqNullSafe(x))).alias("_n"))
    )
    sums = [F.sum(F.col("_n") * F.col("_vector")[i].cast("double")).alias(f"_d{i}") for i in range(dim)]

    def summed(part: DataFrame, by: list[str], size: int) -> DataFrame:
        parts = max(part.sparkSession.sparkContext.defaultParallelism, -(-size // ITEMS_PER_PART))
        ids = part.repartition(parts, *by).select(*by, F.explode_outer(counts).alias("_c")).select(*by, "_c.*")
        return ids.join(side, "_id", "left").groupBy(*by).agg(*sums)

    found = summed(held.where(~slot.isin(*crowded)) if crowded else held, ["_row"], sum(sizes.values()) - many)
    if crowded:
        salt = F.pmod(F.xxhash64("_metadata.file_name", "_metadata.row_index"), F.lit(-(-many // ITEMS_PER_PART)))
        partial = summed(held.withColumn("_salt", salt).where(slot.isin(*crowded)), ["_row", "_salt"], many)
        found = found.unionByName(partial.groupBy("_row").agg(*[F.sum(f"_d{i}").alias(f"_d{i}") for i in range(dim)]))
    return found.select(F.col("_row").alias(row_id), F.array(*[F.coalesce(f"_d{i}", F.lit(0.0)) for i in range(dim)]).alias(name))


def concat_blocks(rows: DataFrame, vectors: Sequence[str], dense: Sequence[str], name: str) -> DataFrame:
    """Vectors, then dense features, as one input vector."""
    blocks = [F.col(v).cast("array<double>") for v in vectors]
    if dense:
        blocks.append(F.array(*[F.col(d).cast("double") for d in dense]))
    return rows.withColumn(name, F.concat(*blocks))


def embedding_export(
    factors: DataFrame, *, key: str, vector: str, entity: str, dim: int, at: datetime, bias: str | None = None
) -> DataFrame:
    """One wide row per entity: id, ``{entity}_emb_i``, ``{entity}_bias``, timestamp."""
    return factors.select(
        F.col(key).alias(f"{entity}Id"),
        *[F.col(vector)[i].alias(f"{entity}_emb_{i}") for i in range(dim)],
        (F.col(bias) if bias else F.lit(0.0)).alias(f"{entity}_bias"),
        F.lit(at).alias("timestamp"),
    )


def refresh_factors(pretrained: DataFrame, refit: DataFrame, key: str, vector: str) -> DataFrame:
    """Factors of the new window where it has any, else the pretrained ones."""
    old = pretrained.select(key, F.col(vector).alias("_old"))
    new = refit.select(key, F.col(vector).alias("_new"))
    return old.join(new, key, "full").select(key, F.coalesce("_new", "_old").alias(vector))
