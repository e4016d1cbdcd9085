"""Implicit-feedback factors from given ones: half-steps of alternating least squares, and export in index order.

With the other side held, an id's factors x solve its own normal equations

    (G + sum w y y' + reg) x = sum (1 + w) y over its positive strengths,     w = alpha * |strength|

where y are the factors of what it interacted with and G sums y y' over the whole other side. G is summed once; the
rest is summed and solved in batches, as an id's rows stream by. Ids with many rows are summed in parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.vectors import dot
from tidemark.operators.embeddings import refresh_factors
from tidemark.session import materialise

#: Rows of an id that one task sums at most, and equations solved at a time.
ROWS_PER_PART, SOLVED_AT_ONCE = 200_000, 256
#: Tasks that the sums of G pass before the driver adds them up.
GRAM_PARTS = 16


@dataclass(frozen=True)
class Strengths:
    """(user, item, strength) rows and how they count. A strength above zero is a preference of 1, any other of 0."""

    rows: DataFrame
    user: str
    item: str
    strength: str
    alpha: float = 1.0
    reg: float = 0.1

    def pairs(self, own: str, other: str) -> DataFrame:
        """(own, other, s): one row a pair, of the sum of its strengths; nulls do not count."""
        named = self.rows.select(
            F.col(own).alias("own"), F.col(other).alias("other"), F.col(self.strength).cast("double").alias("s")
        )
        return named.dropna().groupBy("own", "other").agg(F.sum("s").alias("s"))


def gram(factors: DataFrame, vector: str = "features") -> np.ndarray:
    """The sum of y y' over all vectors; tasks send one matrix each to a few that add them up."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = _matrix(batch.column(0))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["g"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for blob in (blob for batch in batches for blob in batch.column(0).to_pylist()):
            own = np.frombuffer(blob)
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["g"])

    parts = factors.where(F.col(vector).isNotNull()).select(F.col(vector).cast("array<double>")).mapInArrow(sums, "g binary")
    found = [np.frombuffer(r.g) for r in parts.repartition(GRAM_PARTS).mapInArrow(add, "g binary").collect()]
    if not found:
        return np.zeros((0, 0))
    size = int(round(len(found[0]) ** 0.5))
    return np.sum(found, axis=0).reshape(size, size)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def half_step(strengths: Strengths, own: str, other: str, fixed: DataFrame, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """(id, features): the best factors of every id of ``own`` that interacts with an id of ``fixed`` (id, features).

    Ids without factors in ``fixed`` weigh nothing, as if theirs were zero.
    """
    pairs = strengths.pairs(own, other)
    size = pairs.groupBy("own").agg(F.count("*").alias("n")).where(F.col("n") > rows_per_part)
    many = size.select(F.col("own").alias("many"), F.ceil(F.col("n") / rows_per_part).cast("int").alias("parts"))
    side = fixed.where("features IS NOT NULL").select(F.col("id").alias("other_id"), F.col("features").cast("array<double>").alias("y"))
    joined = pairs.join(many, F.col("own") == F.col("many"), "left").join(side, F.col("other") == F.col("other_id"))
    part = F.pmod(F.xxhash64("other"), F.coalesce("parts", F.lit(1))).cast("int")
    rows = joined.select("own", part.alias("part"), F.coalesce("parts", F.lit(1)).alias("parts"), "s", "y")
    whole, alpha = gram(fixed), strengths.alpha
    base = whole + strengths.reg * np.eye(len(whole))
    k = len(base)
    kind = dict(pairs.dtypes)["own"]
    schema = f"id {kind}, features array<double>, a binary, b binary"

    def solved(ids: list, a: list, b: list, id_type: pa.DataType) -> pa.RecordBatch:
        x = np.linalg.solve(base + np.stack(a), np.stack(b)[..., None])[..., 0]
        vectors = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * k, pa.int32()), pa.array(x.ravel()))
        none = pa.nulls(len(x), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(ids, id_type), vectors, none, none], ["id", "features", "a", "b"])

    def partial(own_id: object, a: np.ndarray, b: np.ndarray, id_type: pa.DataType) -> pa.RecordBatch:
        arrays = [pa.array([own_id], id_type), pa.nulls(1, pa.list_(pa.float64())), pa.array([a.tobytes()]), pa.array([b.tobytes()])]
        return pa.RecordBatch.from_arrays(arrays, ["id", "features", "a", "b"])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        key, a, b, id_type = None, None, None, None

        def close() -> Iterator[pa.RecordBatch]:
            if key is None:
                return
            if key[2] > 1:
                yield partial(key[0], a, b, id_type)
                return
            for part, x in zip(held, (key[0], a, b)):
                part.append(x)
            if len(held[0]) == SOLVED_AT_ONCE:
                yield solved(*held, id_type)
                for part in held:
                    part.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            id_type = batch.column("own").type
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("own", "part", "parts"))))
            y, s = _matrix(batch.column("y")), batch.column("s").to_numpy()
            heads = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for start, end in zip(heads, heads[1:]):
                if keys[start] != key:
                    yield from close()
                    key, a, b = keys[start], np.zeros((k, k)), np.zeros(k)
                own_y, own_s = y[start:end], s[start:end]
                weight = alpha * np.abs(own_s)
                a = a + (own_y * weight[:, None]).T @ own_y
                b = b + ((1 + weight) * (own_s > 0)) @ own_y
        yield from close()
        if held[0]:
            yield solved(*held, id_type)

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, a, b, id_type = None, None, None, None
        for batch in batches:
            id_type = batch.column("id").type
            for own_id, more_a, more_b in zip(*(batch.column(c).to_pylist() for c in ("id", "a", "b"))):
                more_a, more_b = np.frombuffer(more_a).reshape(k, k), np.frombuffer(more_b)
                if own_id == key:
                    a, b = a + more_a, b + more_b
                    continue
                if key is not None:
                    yield solved([key], [a], [b], id_type)
                key, a, b = own_id, more_a, more_b
        if key is not None:
            yield solved([key], [a], [b], id_type)

    dealt = rows.repartition("own", "part").sortWithinPartitions("own", "part")
    found = materialise(dealt.mapInArrow(sums, schema), "halfstep")
    parts = found.where("features IS NULL").repartition("id").sortWithinPartitions("id").mapInArrow(united, schema)
    return found.where("features IS NOT NULL").unionByName(parts).select("id", "features")


def loss(strengths: Strengths, users: DataFrame, items: DataFrame) -> float:
    """The objective over all pairs, those without a strength included, by way of both sides' G."""
    g, h = gram(users), gram(items)
    pairs = strengths.pairs(strengths.user, strengths.item)
    x = users.select(F.col("id").alias("own"), F.col("features").cast("array<double>").alias("x"))
    y = items.select(F.col("id").alias("other"), F.col("features").cast("array<double>").alias("y"))
    guessed = pairs.join(x, "own", "left").join(y, "other", "left").withColumn("g", F.coalesce(dot(F.col("x"), F.col("y")), F.lit(0.0)))
    off = f"(1 + {strengths.alpha}D * abs(s)) * pow(CASE WHEN s > 0 THEN 1 ELSE 0 END - g, 2) - g * g"
    seen = guessed.agg(F.expr(f"sum({off}) AS off")).first()["off"] or 0.0
    return float(np.sum(g * h) + seen + strengths.reg * (np.trace(g) + np.trace(h)))


def refit(strengths: Strengths, users: DataFrame, items: DataFrame, half_steps: int = 2) -> tuple[DataFrame, DataFrame]:
    """(users, items) after some half-steps from given factors (id, features), users first.

    Ids that do not interact keep their factors, new ones get theirs; the loss falls, or stays, in each half-step.
    """
    ids, tables = [strengths.user, strengths.item], [users, items]
    for step in range(half_steps):
        own, other = ids[step % 2], ids[1 - step % 2]
        fresh = half_step(strengths, own, other, tables[1 - step % 2])
        tables[step % 2] = materialise(refresh_factors(tables[step % 2], fresh, "id", "features"), "factors")
    return tables[0], tables[1]


def export_in_order(rows: DataFrame, index: str, path: str, rows_per_file: int = 1_000_000) -> DataFrame:
    """Write ``rows`` as parquet files of which the order of names, and the rows within, is the order of ``index``.

    ``index`` counts from 0, such as a dense index does; a file holds the rows of ``rows_per_file`` of its numbers. Returns
    the manifest (file, first_index, last_index, n_rows), which is written beside the files as JSON lines.
    """
    spark = rows.sparkSession
    last = rows.agg(F.max(index)).first()[0]
    files = 1 if last is None else last // rows_per_file + 1
    dealt = rows.repartitionById(files, F.expr(f"CAST(`{index}` DIV {rows_per_file} AS INT)")).sortWithinPartitions(index)
    dealt.write.mode("overwrite").parquet(f"{path}/rows")
    named = spark.read.schema(rows.schema).parquet(f"{path}/rows").select(index, F.col("_metadata.file_name").alias("file"))
    manifest = named.groupBy("file").agg(
        F.min(index).alias("first_index"), F.max(index).alias("last_index"), F.count("*").alias("n_rows")
    )
    manifest.orderBy("file").coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return spark.read.schema(manifest.schema).json(f"{path}/manifest")


def read_in_order(spark: SparkSession, path: str, schema: str, position: str = "position") -> DataFrame:
    """The exported rows plus their place in the order: the rows of all files before theirs, and those before them in it."""
    rows = spark.read.schema(schema).parquet(f"{path}/rows")
    placed = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    manifest = spark.read.schema("file STRING, n_rows BIGINT").json(f"{path}/manifest")
    starts = manifest.selectExpr("file AS _file", "sum(n_rows) OVER (ORDER BY file) - n_rows AS _start")  # one row a file
    return placed.join(starts, "_file").withColumn(position, F.col("_start") + F.col("_row")).drop("_file", "_row", "_start")
