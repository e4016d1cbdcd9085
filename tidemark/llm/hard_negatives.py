"""Hard negatives by integer inner products, from rotated one-bit codes whose intervals rule candidates out.

A vector v is rotated several times and only the signs are kept. Let c be the sum of the rotated-back signs, as
a vector of v's own space. Stored with the code is how it is aligned with v: then v is (v·c / c·c) c and a residual of
known length at a right angle to c. For a query q, c·q is estimated by counting bits of the code under the bit planes
of the rotated, rounded q; rounding has a known bound. By Cauchy and Schwarz the residual adds at most its length times
that of q's part at a right angle to c. So every inner product lies in a deterministic interval: rows whose interval
cannot reach the result are left out without loss, and the others are scored in integers.

Rows stay where they are, in blocks; anchors are read from stored files, a file at a time. Of each block and
anchor only the best rows leave the task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import storage
from tidemark.session import materialise
from tidemark.sources.tables import spread

#: Rows that a task holds as one block, and anchors that it reads at once.
BLOCK_ROWS, ANCHOR_ROWS = 65_536, 2_048
#: Rows scored at first; each further step takes twice as many.
STEP = 64
#: Bits of a code, at least, and bit planes of a query.
BITS, PLANES = 1_024, 8
STORED = "id long, label string, d int, ints binary, code binary, aligned double, square double, rest double"


@lru_cache(maxsize=4)
def rotations(d: int, bits: int, seed: int) -> np.ndarray:
    """(d, m) with m >= ``bits``: random rotations side by side, scaled so that lengths stay as they are."""
    count = -(-bits // d)
    rng = np.random.default_rng([seed, d])
    turned = [np.linalg.qr(rng.standard_normal((d, d)))[0] for _ in range(count)]
    return np.hstack(turned) / np.sqrt(count)


def _packed(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    width = -(-bits.shape[1] // 64) * 64
    padded = np.zeros((len(bits), width), bool)
    padded[:, : bits.shape[1]] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


@dataclass
class Codes:
    """``words``: the signs; ``aligned``: v·c; ``square``: c·c; ``rest``: the residual's length."""

    words: np.ndarray
    aligned: np.ndarray
    square: np.ndarray
    rest: np.ndarray


def encode(vectors: np.ndarray, matrix: np.ndarray) -> Codes:
    turned = vectors @ matrix
    signs = turned > 0
    unit = np.where(signs, 1.0, -1.0) / np.sqrt(matrix.shape[1])
    back = unit @ matrix.T
    aligned, square = (turned * unit).sum(axis=1), (back**2).sum(axis=1)
    rest = (vectors**2).sum(axis=1) - aligned**2 / np.maximum(square, 1e-300)
    return Codes(_packed(signs), aligned, square, np.sqrt(np.maximum(rest, 0.0)))


class Queries:
    """Anchors as bit planes of their rotated components, rounded to ``2 ** planes`` steps."""

    def __init__(self, vectors: np.ndarray, matrix: np.ndarray, planes: int):
        turned = vectors.astype(np.float64) @ matrix
        self.m = matrix.shape[1]
        self.low = turned.min(axis=1)
        self.step = np.maximum(turned.max(axis=1) - self.low, 1e-12) / (2**planes - 1)
        rounded = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        self.total = rounded.sum(axis=1)
        off = np.abs(turned - self.low[:, None] - rounded * self.step[:, None]).sum(axis=1)
        self.off = off / np.sqrt(self.m) + 1e-9
        self.square = (vectors.astype(np.float64) ** 2).sum(axis=1)
        self.planes = [_packed((rounded >> j & 1).astype(bool)) for j in range(planes)]

    def intervals(self, i: int, codes: Codes, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) of the i-th query's inner product with each coded vector; ``ones`` counts the codes' bits."""
        under = np.zeros(len(ones))
        for j, plane in enumerate(self.planes):
            under += 2.0**j * np.bitwise_count(codes.words & plane[i]).sum(axis=1, dtype=np.int64)
        about = 2 * self.low[i] * ones + 2 * self.step[i] * under - self.m * self.low[i] - self.step[i] * self.total[i]
        about /= np.sqrt(self.m)
        square = np.maximum(codes.square, 1e-300)
        scale = codes.aligned / square
        across = self.square[i] - np.maximum(np.abs(about) - self.off[i], 0.0) ** 2 / square
        width = scale * self.off[i] + codes.rest * np.sqrt(np.maximum(across, 0.0))
        width += 1e-6 + 1e-9 * np.sqrt(self.square[i]) * (codes.rest + scale * np.sqrt(square))  # rounding of the doubles
        return scale * about - width, scale * about + width


@dataclass
class Block:
    """Some rows of one dimension."""

    ids: np.ndarray
    labels: np.ndarray
    ints: np.ndarray
    codes: Codes

    def __post_init__(self):
        self.ones = np.bitwise_count(self.codes.words).sum(axis=1, dtype=np.int64)
        self.names, self.kinds = np.unique(self.labels, return_inverse=True)
        order = np.argsort(self.kinds, kind="stable")
        ends = np.cumsum(np.bincount(self.kinds, minlength=len(self.names)))
        self.members = {n: order[a:b] for n, a, b in zip(self.names.tolist(), [0, *ends[:-1]], ends)}
        self.scored = self.seen = 0

    def _best(self, at: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The best ``k`` (score, id), ties to the smaller id."""
        order = np.lexsort((self.ids[at], -scores))[:k]
        return list(zip(scores[order].tolist(), self.ids[at[order]].tolist()))

    def _search(
        self, at: np.ndarray, least: np.ndarray, most: np.ndarray, query: np.ndarray, bands: list[tuple[float, float]], k: int
    ) -> list[list[tuple[int, int]]]:
        """For each band of scores, the best ``k`` (score, id) of the rows ``at`` within it.

        Rows are scored by falling upper end, until no upper end left reaches any band's worst score so far.
        """
        self.seen += len(at)
        fit = np.zeros(len(at), bool)
        for low, high in bands:
            fit |= (most >= low) & (least <= high)
        at, least, most = at[fit], least[fit], most[fit]
        order = np.argsort(-most, kind="stable")
        held: list[list[tuple[int, int]]] = [[] for _ in bands]
        taken, width = 0, STEP
        while taken < len(order):
            needs = [low if len(best) < k else max(low, best[-1][0]) for (low, _), best in zip(bands, held)]
            if most[order[taken]] < min(needs, default=math.inf):
                break
            some = order[taken : taken + width]
            taken, width = taken + width, 2 * width
            reached = np.zeros(len(some), bool)
            for (_, high), need in zip(bands, needs):
                reached |= (most[some] >= need) & (least[some] <= high)
            own = at[some[reached]]
            scores = self.ints[own] @ query
            self.scored += len(own)
            for i, (low, high) in enumerate(bands):
                within = (scores >= low) & (scores <= high)
                held[i] = sorted(held[i] + self._best(own[within], scores[within], k), key=lambda hit: (-hit[0], hit[1]))[:k]
        return held

    def positives(self, queries: Queries, i: int, query: np.ndarray, own: int, label: str, k: int) -> list[tuple[int, int]]:
        """The best ``k`` (score, id) of the label's other rows."""
        at = self.members.get(label, np.empty(0, np.int64))
        at = at[self.ids[at] != own]
        part = Codes(self.codes.words[at], self.codes.aligned[at], self.codes.square[at], self.codes.rest[at])
        least, most = queries.intervals(i, part, self.ones[at])
        return self._search(at, least, most, query, [(-math.inf, math.inf)], k)[0]

    def negatives(
        self, queries: Queries, i: int, query: np.ndarray, label: str, bands: list[tuple[int, int]], k: int
    ) -> list[list[tuple[int, int]]]:
        """For each band of scores, the best ``k`` (score, id) of other labels' rows within it."""
        other = np.ones(len(self.ids), bool)
        other[self.members.get(label, [])] = False
        least, most = queries.intervals(i, self.codes, self.ones)
        return self._search(np.flatnonzero(other), least[other], most[other], query, bands, k)


def _usable(rows: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, ints): one row an id, of those that take part."""
    named = rows.select(
        rows[key].cast("long").alias("id"), rows[label].cast("string").alias("label"), rows[vector].cast("array<double>").alias("x")
    )
    bad = F.exists("x", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    known = named.where("id IS NOT NULL AND label IS NOT NULL AND size(x) > 0").where(~bad)
    most = F.array_max(F.transform("x", F.abs)) * scale + 1
    fit = known.where(most * most * F.size("x") < 2.0**62)
    ints = fit.select("id", "label", F.transform("x", lambda x: F.floor(x * scale).cast("long")).alias("ints"))
    return ints.groupBy("id").agg(F.min(F.struct("label", "ints")).alias("row")).select("id", "row.*")


def _stored(rows: DataFrame, bits: int, seed: int) -> DataFrame:
    """The rows with their codes."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ints = batch.column("ints")
            sizes = np.diff(ints.offsets.to_numpy())
            for d in np.unique(sizes).tolist():
                own = batch.filter(pa.array(sizes == d))
                values = own.column("ints").flatten().to_numpy().reshape(-1, d)
                codes = encode(values.astype(np.float64), rotations(d, bits, seed))
                yield pa.RecordBatch.from_arrays(
                    [
                        own.column("id"),
                        own.column("label"),
                        pa.array(np.full(len(values), d, np.int32)),
                        pa.array([x.tobytes() for x in values.astype("<i4")], pa.binary()),
                        pa.array([x.tobytes() for x in codes.words], pa.binary()),
                        *[pa.array(x) for x in (codes.aligned, codes.square, codes.rest)],
                    ],
                    names=[field.split()[0] for field in STORED.split(", ")],
                )

    return rows.mapInArrow(code, STORED)


def _bytes(column: pa.ChunkedArray | pa.Array, kind: str, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(n, -1)


def _blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[Block]:
    """Blocks of at most about ``rows`` rows, each of one dimension."""

    def made(held: list[pa.RecordBatch]) -> Iterator[Block]:
        table = pa.Table.from_batches(held)
        sizes = table.column("d").to_numpy()
        for d in np.unique(sizes).tolist():
            own = table.filter(pa.array(sizes == d))
            n = len(own)
            codes = Codes(_bytes(own.column("code"), "<u8", n), *(own.column(c).to_numpy() for c in ("aligned", "square", "rest")))
            labels = np.array(own.column("label").to_pylist(), object)
            yield Block(own.column("id").to_numpy(), labels, _bytes(own.column("ints"), "<i4", n).astype(np.int64), codes)

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield from made(held)
            held, size = [], 0
    if size:
        yield from made(held)


def _anchors(files: list[str], d: int) -> Iterator[pa.Table]:
    """The stored anchors of one dimension, some at a time."""
    for uri in files:
        system, path = storage.resolve(uri)
        with system.open_input_file(path) as file:
            for batch in pq.ParquetFile(file).iter_batches(batch_size=ANCHOR_ROWS):
                table = pa.Table.from_batches([batch])
                own = table.filter(pa.array(table.column("d").to_numpy() == d))
                if len(own):
                    yield own


def _best(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """(keys, at, score, id): the best ``k`` of each group, ties to the smaller id; parts first, then their best."""
    hit = F.struct((-F.col("score")).alias("s"), "id")
    some = found.groupBy(*keys, F.pmod("part", F.lit(64)).alias("part")).agg(F.slice(F.array_sort(F.collect_list(hit)), 1, k).alias("hits"))
    best = some.groupBy(*keys).agg(F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k).alias("hits"))
    return best.select(*keys, F.posexplode("hits").alias("at", "hit")).select(
        *keys, "at", (-F.col("hit.s")).alias("score"), F.col("hit.id").alias("id")
    )


def hard_negatives(
    rows: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    band: tuple[int, int, int] = (80, 100, 100),
    bits: int = BITS,
    planes: int = PLANES,
    block_rows: int = BLOCK_ROWS,
    seed: int = 17,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of each anchor and positive.

    A component x counts as floor(``scale`` * x); scores are inner products of those, ties go to the smaller id. ``anchor``
    is a condition on ``id`` that picks the anchors. An anchor's positives are its best ``positives`` other
    rows of its label. A positive's negatives are the best ``negatives`` rows of other labels with band[0] * p <= band[2] * n <=
    band[1] * p, where p and n are the scores; none leaves no row. Rows take no part if id, label or vector is null,
    the vector is empty, or a component is null, not finite, or so large that a score might not fit 64 bits. Of rows with one id,
    that of the smallest label, then vector, stands for all. Vectors of other lengths than the anchor's are no
    candidates. Other columns are not read; an empty table gives no rows.
    """
    spark = rows.sparkSession
    storage.small_batches(spark)
    low, high, of = band
    stored = spread(materialise(_stored(_usable(rows, key, vector, label, scale), bits, seed), "codes"))
    asked = materialise(stored.where(anchor).select("id", "label", "d", "ints"), "anchors")

    def search(files: list[str], negative: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part = TaskContext.get().partitionId()
            for block in _blocks(batches, block_rows):
                d = block.ints.shape[1]
                for some in _anchors(files, d):
                    vectors = _bytes(some.column("ints"), "<i4", len(some)).astype(np.int64)
                    queries = Queries(vectors, rotations(d, bits, seed), planes)
                    ids, labels = some.column("id").to_pylist(), some.column("label").to_pylist()
                    out: list[tuple] = []
                    if negative:
                        theirs = some.column("positives").to_pylist()
                        for i, own in enumerate(ids):
                            bands = [(-(-low * p["score"] // of), high * p["score"] // of) for p in theirs[i]]
                            hits = block.negatives(queries, i, vectors[i], labels[i], bands, negatives)
                            out += [(own, p["id"], p["score"], part, s, n) for p, best in zip(theirs[i], hits) for s, n in best]
                    else:
                        for i, own in enumerate(ids):
                            hits = block.positives(queries, i, vectors[i], own, labels[i], positives)
                            out += [(own, None, None, part, s, n) for s, n in hits]
                    if out:
                        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
                        columns = [pa.array(c, kind) for c, kind in zip(zip(*out), kinds)]
                        yield pa.RecordBatch.from_arrays(columns, names=["anchor_id", "positive_id", "positive_score", "part", "score", "id"])

        return run

    schema = "anchor_id long, positive_id long, positive_score long, part int, score long, id long"
    files = list(asked.inputFiles())  # one a writing task
    nearest = _best(stored.mapInArrow(search(files, False), schema), ["anchor_id"], positives)
    theirs = nearest.groupBy("anchor_id").agg(F.collect_list(F.struct("id", "score")).alias("positives"))
    paired = materialise(asked.join(theirs, asked["id"] == theirs["anchor_id"]).drop("anchor_id"), "positives")
    files = list(paired.inputFiles())
    found = stored.mapInArrow(search(files, True), schema)
    ranked = _best(found, ["anchor_id", "positive_id", "positive_score"], negatives)
    return ranked.select(
        "anchor_id",
        "positive_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
