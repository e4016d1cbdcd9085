"""Nearest neighbours by largest inner product, from low-dimensional projections in kd-trees.

Vectors get one more component that makes them all equally long, and a query is stretched to that length, so that the
largest inner product is the smallest distance. Gaussian projections are stable: a projected squared distance is the
true one times a chi-square variable with as many degrees of freedom as there are projections. Each block of vectors
is a file of kd-trees over its projections, one a band of lengths. A query walks a tree by a priority queue of boxes, which
yields the vectors shell by shell in order of their projected distance, and verifies them exactly, until a chi-square
test says that a better vector would, with the wanted probability, have been met by now.
"""

from __future__ import annotations

import heapq
import io
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import storage
from tidemark.session import materialise, scratch_path

LEAF = 256
#: a shell reaches this much farther than the one before, in squared distance
GROWTH = 1.3
#: a band holds vectors whose lengths differ by this factor at most; the last holds all shorter ones
BAND, BANDS = 1.25, 12
#: more than the error of a product of unit vectors in single precision
SLACK = 1e-4


def chi_square_quantile(p: float, freedom: int) -> float:
    """The value that a chi-square variable stays below with probability ``p`` (even degrees of freedom)."""
    if freedom % 2:
        raise ValueError("the number of projections must be even")
    low, high = 0.0, 1000.0
    for _ in range(100):
        x = (low + high) / 2
        term, total = math.exp(-x / 2), 0.0
        for i in range(freedom // 2):
            total += term
            term *= x / 2 / (i + 1)
        low, high = (x, high) if 1 - total < p else (low, x)
    return (low + high) / 2


def projections(dimension: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimension + 1, count))


class Tree:
    """A kd-tree over projected points, which lie in the order of its leaves."""

    FIELDS = ("points", "low", "high", "child", "start", "stop")

    def __init__(self, points, low, high, child, start, stop):
        self.points, self.low, self.high = points, low, high
        self.child, self.start, self.stop = child.tolist(), start.tolist(), stop.tolist()

    @classmethod
    def grown(cls, points: np.ndarray) -> tuple[Tree, np.ndarray]:
        """The tree, and the order its points have been brought into."""
        order = np.arange(len(points))
        child, start, stop = [-1], [0], [len(points)]
        for node in _growing(child):
            a, b = start[node], stop[node]
            if b - a <= LEAF:
                continue
            own = points[order[a:b]]
            half = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, int(np.argmax(np.ptp(own, axis=0)))], half)]
            child[node] = len(child)
            child += [-1, -1]
            start += [a, a + half]
            stop += [a + half, b]
        points = points[order]
        low = np.array([points[a:b].min(axis=0) for a, b in zip(start, stop)])
        high = np.array([points[a:b].max(axis=0) for a, b in zip(start, stop)])
        return cls(points, low, high, np.array(child), np.array(start), np.array(stop)), order


def _growing(nodes: list) -> Iterator[int]:
    """Places of a list that grows meanwhile."""
    node = 0
    while node < len(nodes):
        yield node
        node += 1


class Walk:
    """The points of a tree in order of their squared distance from a place."""

    def __init__(self, tree: Tree, place: np.ndarray):
        self.tree, self.place = tree, place.astype(tree.points.dtype)
        self.boxes = [(0.0, 0)]  # a heap of (least distance, node)
        self.near, self.at = np.empty(0), np.empty(0, np.int64)  # met, in no shell so far
        self.opened: list[tuple[int, int]] = []

    def _open(self) -> None:
        _, node = heapq.heappop(self.boxes)
        tree, child = self.tree, self.tree.child[node]
        if child < 0:
            self.opened.append((tree.start[node], tree.stop[node]))
            return
        gap = np.maximum(tree.low[child : child + 2] - self.place, self.place - tree.high[child : child + 2])
        np.maximum(gap, 0.0, out=gap)
        left, right = (gap * gap).sum(axis=1).tolist()
        heapq.heappush(self.boxes, (left, child))
        heapq.heappush(self.boxes, (right, child + 1))

    def _measure(self) -> None:
        if self.opened:
            points = np.concatenate([self.tree.points[a:b] for a, b in self.opened])
            points -= self.place
            near = np.einsum("ij,ij->i", points, points)
            self.near = np.concatenate([self.near, near])
            self.at = np.concatenate([self.at, *[np.arange(a, b) for a, b in self.opened]])
            self.opened = []

    def reach(self, count: int) -> float:
        """A distance within which about ``count`` points lie."""
        while self.boxes and sum(b - a for a, b in self.opened) < count:
            self._open()
        self._measure()
        return float(np.partition(self.near, min(count, len(self.near)) - 1)[min(count, len(self.near)) - 1])

    def shell(self, distance: float) -> np.ndarray:
        """The points up to ``distance`` that no shell before has held."""
        while self.boxes and self.boxes[0][0] <= distance:
            self._open()
        self._measure()
        inside = self.near <= distance
        found, self.near, self.at = self.at[inside], self.near[~inside], self.at[~inside]
        return found

    def least(self) -> float:
        """No point left is nearer than this; infinity if there is none."""
        return min(self.near.min(initial=math.inf), self.boxes[0][0] if self.boxes else math.inf)


class Block:
    """Some distinct vectors of one dimension with their ids: a kd-tree over the projections of each band of lengths."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, matrix: np.ndarray, k: int):
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        heads = np.flatnonzero(np.concatenate(([True], (vectors[1:] != vectors[:-1]).any(axis=1))))
        ends = np.append(heads[1:], len(ids))
        # equal vectors are one point with its smallest ids, ``k`` times each at most and 2 ``k`` in all: if a query's
        # own id is among them, ``k`` others are left, and more can be in no result
        runs = np.concatenate(([True], ids[1:] != ids[:-1]))
        runs[heads] = True
        starts = np.flatnonzero(runs)
        early = np.arange(len(ids)) - np.repeat(starts, np.diff(np.append(starts, len(ids)))) < k
        kept = [ids[a:b][early[a:b]][: 2 * k] for a, b in zip(heads, ends)]
        first, last, vectors = ids[heads], ids[ends - 1], vectors[heads]
        lengths = np.sqrt((vectors**2).sum(axis=1))
        bands = np.minimum(np.log(lengths.max() / lengths) / math.log(BAND), BANDS - 1).astype(int)
        self.trees, self.norms, self.offsets, places = [], [], [0], []
        for band in np.unique(bands):
            at = np.flatnonzero(bands == band)
            norm = float(lengths[at].max())
            rest = np.sqrt(np.maximum(0.0, norm**2 - lengths[at] ** 2))
            tree, own = Tree.grown((np.column_stack([vectors[at], rest]) @ matrix / lengths.max()).astype(np.float32))
            self.trees.append(tree)
            self.norms.append(norm)
            self.offsets.append(self.offsets[-1] + len(at))
            places.append(at[own])
        at = np.concatenate(places)
        self.vectors, self.first, self.last, self.matrix = vectors[at], first[at], last[at], matrix
        self.rough = (self.vectors / lengths.max()).astype(np.float32)
        self.ends = np.cumsum([0, *[len(kept[i]) for i in at]])
        self.ids = np.concatenate([kept[i] for i in at])
        self.verified = self.asked = 0

    def write(self, out) -> None:
        """The block as consecutive arrays."""
        plain = (self.vectors, self.rough, self.first, self.last, self.matrix, self.ends, self.ids, np.array(self.norms), np.array(self.offsets))
        for array in (*plain, *[np.asarray(getattr(tree, name)) for tree in self.trees for name in Tree.FIELDS]):
            held = io.BytesIO()
            np.save(held, array, allow_pickle=False)
            out.write(held.getbuffer())

    @classmethod
    def read(cls, uri: str) -> Block:
        file, block = io.BytesIO(storage.mapped(uri)), cls.__new__(cls)
        load = lambda: np.load(file, allow_pickle=False)
        block.vectors, block.rough, block.first, block.last, block.matrix, block.ends, block.ids = (load() for _ in range(7))
        block.norms, block.offsets = load().tolist(), load().tolist()
        block.trees = [Tree(*(load() for _ in Tree.FIELDS)) for _ in block.norms]
        block.verified = block.asked = 0
        return block

    def search(self, query: np.ndarray, own_id: int, k: int, quantile: float) -> list[tuple[float, int]]:
        """Up to ``k`` (score, id), best first, ties to the smaller id; ``own_id`` is no candidate."""
        length, longest = math.sqrt(float(query @ query)), self.norms[0]  # trees are in units of the longest vector
        small = (query / length).astype(np.float32)
        held: list[tuple[float, int]] = []  # (-score, id), sorted
        self.asked += 1
        walks = []
        for tree, norm, offset in zip(self.trees, self.norms, self.offsets):  # the nearest points of each band first
            walk = Walk(tree, (query * (norm / length / longest)) @ self.matrix[:-1])
            distance = walk.reach(k)
            walks.append((walk, distance, norm, offset))
            held = self._verify(offset + walk.shell(distance), query, small, own_id, k, held)
        for walk, distance, norm, offset in walks:
            if len(held) == k and -held[-1][0] > norm * length * (1 + 1e-9):
                break  # no vector as short as this reaches the k-th best score
            while (left := walk.least()) < math.inf:
                # the squared distance of the k-th best so far, and the projected one that a better one hardly exceeds
                worst = max(0.0, 2 * norm**2 + 2 * norm / length * held[-1][0]) if len(held) == k else math.inf
                end = quantile * (worst / longest**2 + 1e-6)
                if left > end:
                    break
                distance = min(max(distance * GROWTH, left), end)
                held = self._verify(offset + walk.shell(distance), query, small, own_id, k, held)
        return [(-s, i) for s, i in held]

    def _verify(self, at: np.ndarray, query: np.ndarray, small: np.ndarray, own_id: int, k: int, held: list) -> list[tuple[float, int]]:
        """``held`` with the exact scores of the vectors ``at``; single precision rules most of them out."""
        self.verified += len(at)
        at = at[(self.first[at] != own_id) | (self.last[at] != own_id)]  # the rest are its own rows
        rough = self.rough[at] @ small
        unit = self.norms[0] * math.sqrt(float(query @ query))
        least = -held[-1][0] / unit if len(held) == k else -math.inf
        if len(rough) > 2 * k:
            least = max(least, float(np.partition(rough, len(rough) - k)[len(rough) - k]) - SLACK)
        at = at[rough >= least - SLACK]
        if not len(at):
            return held
        found = list(held)
        for p, s in zip(at, _products(self.vectors[at], query)):
            found += [(-float(s), i) for i in self.ids[self.ends[p] : self.ends[p + 1]].tolist() if i != own_id]
        return sorted(found)[:k]


def _products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed in order of the components: the same number wherever it is computed."""
    return np.cumsum(vectors * query, axis=1)[:, -1] if vectors.shape[1] else np.zeros(len(vectors))


def _usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector of doubles) of rows that take part: neither null, empty, zero, nor holding what is no number."""
    rows = df.select(df[key].cast("long").alias("id"), df[vector].cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & ~bad & F.exists("vector", lambda x: x != 0))


def _dealt(df: DataFrame, into: int, *by: Column) -> DataFrame:
    """``df`` with its vectors' dimension and one of ``into`` parts, by hash of the id and ``by``."""
    part = F.pmod(F.xxhash64("id", *by), F.lit(into)).cast("int")
    return df.withColumn("part", part).withColumn("dimension", F.size("vector"))


def _vectors(table: pa.Table) -> np.ndarray:
    return table.column("vector").combine_chunks().flatten().to_numpy().reshape(len(table), -1)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    projected: int = 16,
    probability: float = 0.95,
    block_rows: int = 65_536,
    query_rows: int = 256,
    seed: int = 11,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each query among all other rows.

    Null ids and vectors, zero vectors and vectors with a null or non-finite component take no part.
    Vectors of other lengths than the query's are no candidates. Rows with the query's id are no
    candidates of it; other repeated rows are candidates each. Repeated rows of a query are one query: of
    different vectors with one id, the smallest, compared component by component, is asked. Other columns are not
    read; an empty table gives no rows. The vectors lie in blocks of about ``block_rows``, each written once
    as a file of trees; a task reads a block and a file of about ``query_rows`` queries, and only the best ``k`` of
    a block leave it. The stopping test makes each true neighbour found with ``probability`` at least.
    """
    spark = vectors.sparkSession
    storage.small_batches(spark, 5_000)
    base, asked = _usable(vectors, key, vector), _usable(queries, key, vector).groupBy("id").agg(F.min("vector").alias("vector"))
    blocks, groups = max(1, -(-base.count() // block_rows)), max(1, -(-asked.count() // query_rows))
    quantile = chi_square_quantile(probability, projected)
    trees, asks = scratch_path(spark, "trees"), scratch_path(spark, "queries")

    def grow(table: pa.Table) -> pa.Table:
        values, uri = _vectors(table), storage.fresh(trees, ".trees")
        block = Block(table.column("id").to_numpy(), values, projections(values.shape[1], projected, seed), k)
        with storage.create(uri) as out:
            block.write(out)
        return pa.table({"dimension": pa.array([values.shape[1]], pa.int32()), "block": [uri]})

    def put(table: pa.Table) -> pa.Table:
        values, uri = _vectors(table), storage.fresh(asks, ".queries")
        with storage.create(uri) as out:
            for array in (table.column("id").to_numpy(), values):
                held = io.BytesIO()
                np.save(held, array, allow_pickle=False)
                out.write(held.getbuffer())
        return pa.table({"dimension": pa.array([values.shape[1]], pa.int32()), "asks": [uri]})

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, block = None, None
        for batch in batches:
            for own, some in zip(batch.column("block").to_pylist(), batch.column("asks").to_pylist()):
                uri, block = own, block if own == uri else Block.read(own)
                file = io.BytesIO(storage.mapped(some))
                ids, values = np.load(file, allow_pickle=False), np.load(file, allow_pickle=False)
                found = [(q, s, i) for q, x in zip(ids.tolist(), values) for s, i in block.search(x, q, k, quantile)]
                columns = list(zip(*found)) or [(), (), ()]
                kinds = (pa.int64(), pa.float64(), pa.int64())
                parts = pa.array([zlib.crc32(own.encode()) % 64] * len(found), pa.int32())
                yield pa.RecordBatch.from_arrays([*[pa.array(c, t) for c, t in zip(columns, kinds)], parts], names=["query_id", "score", "vec_id", "part"])

    # rows repeated under one id are dealt apart by their place
    grown = _dealt(base, blocks, F.monotonically_increasing_id()).groupBy("part", "dimension").applyInArrow(grow, "dimension int, block string")
    stored = _dealt(asked, groups).groupBy("part", "dimension").applyInArrow(put, "dimension int, asks string")
    # names of files only, one row a block and a query file; a task's pairs lie block by block
    pairs = materialise(grown, "blocks").join(materialise(stored, "asks"), "dimension")
    each = pairs.repartition(max(1, min(blocks * groups, 10_000)), "block", "asks").sortWithinPartitions("block")
    found = each.mapInArrow(storage.trimmed(search), "query_id long, score double, vec_id long, part int")
    best = F.struct((-F.col("score")).alias("s"), "vec_id")
    # at most k rows of each block and query come together here, parts of the blocks first
    some = found.groupBy("query_id", "part").agg(F.slice(F.array_sort(F.collect_list(best)), 1, k).alias("best"))
    top = some.groupBy("query_id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k).alias("best"))
    ranked = top.select("query_id", F.posexplode("best").alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score"))
