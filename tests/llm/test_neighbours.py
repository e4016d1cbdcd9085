from __future__ import annotations

import math

import numpy as np
import pytest
from oracle import SF_DIR

from tidemark.llm import neighbours
from tidemark.llm.queries import QUERIES


def brute(rows, queries, k):
    found = {}
    for q, x in queries:
        scores = [(-float(sum(a * b for a, b in zip(map(float, v), map(float, x)))), i) for i, v in rows if i != q and len(v) == len(x)]
        found.setdefault(q, sorted(scores)[:k])
    return found


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall(spark, sf):
    folder = SF_DIR.replace("sf0.01", sf)
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    got = {}
    for r in QUERIES["op4_neighbours"](spark, folder).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert got.keys() == want.keys()
    hits = 0
    for q, best in want.items():
        own = sorted(got[q])
        assert [r for r, _, _ in own] == list(range(1, len(best) + 1))
        assert [(-s, i) for _, i, s in own] == sorted((-s, i) for _, i, s in own)
        exact = dict((i, -s) for s, i in brute([(i, v) for i, v in rows if i in {x for _, x, _ in own}], [(q, dict(rows)[q])], 20)[q])
        assert all(s == pytest.approx(exact[i], abs=1e-12) for _, i, s in own)
        hits += len({i for _, i in best} & {i for _, i, _ in own})
    recall = hits / sum(map(len, want.values()))
    print("recall", recall)
    assert recall >= 0.95


def test_odd_vectors_ties_and_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(i, [1.0, 0, 0, 0, 0, 9.0]) for i in range(1000, 1100)]  # many equal vectors
    bad = [(2000, None), (2001, []), (2002, [0.0] * 6), (2003, [1.0, None, 0, 0, 0, 0.0]), (2004, [float("nan")] * 6), (2005, [float("inf"), 0, 0, 0, 0, 0.0]), (None, [9.0] * 6)]
    other = [(3000, [5.0, 5.0]), (3001, [1.0, 2.0])]
    rows += [(7, [3.0] * 6), (7, [3.0] * 6)]
    floats = lambda v: v and [None if x is None else float(x) for x in v]
    df = spark.createDataFrame([(i, floats(v), 1) for i, v in rows + bad + other], "vec_id long, embedding array<double>, block int")
    asked = [0, 7, 1000, 1050, 2002, 2004, 3000]
    got = {}
    # a probability this close to one searches everything
    found = neighbours.nearest(df, df.where(df.vec_id.isin(asked)).dropDuplicates(["vec_id"]), probability=1 - 1e-12, block_rows=64, query_rows=3)
    for r in found.collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    assert set(got) == {0, 7, 1000, 1050, 3000}
    usable = rows + other
    firsts = {i: v for i, v in reversed(usable)}
    for q in (0, 1000, 1050, 3000):
        assert [i for _, i in sorted(got[q])] == [i for _, i in brute(usable, [(q, firsts[q])], 20)[q]]
    assert 7 not in {i for _, i in got[7]}
    assert neighbours.nearest(df.where("false"), df).count() == 0
    assert neighbours.nearest(df, df.where("false")).count() == 0


def test_repeated_queries(spark):
    """A query that is stored many times is asked once, and its own rows push no other out of the result."""
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(200)]
    rows += [(20, rows[20][1])] + [(40, rows[40][1])] * 40 + [(41, rows[40][1]), (43, rows[40][1])]
    rows += [(60, [x + 0.001 * i for x in rows[60][1]]) for i in range(1, 300)]  # one id with many vectors
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for block_rows in (64, 4_096):
        found = neighbours.nearest(df, df.where("vec_id % 20 = 0"), k=20, probability=1 - 1e-12, block_rows=block_rows, query_rows=3)
        got = {}
        for r in found.collect():
            got.setdefault(r.query_id, []).append((r.rank, r.vec_id))
        firsts = {i: min(v for j, v in rows if j == i) for i in range(0, 200, 20)}
        want = brute(rows, list(firsts.items()), 20)
        assert {q: sorted(own) for q, own in got.items()} == {q: [(n, i) for n, (_, i) in enumerate(best, 1)] for q, best in want.items()}


def test_quantile():
    assert neighbours.chi_square_quantile(0.95, 2) == pytest.approx(5.991464547)
    assert neighbours.chi_square_quantile(0.95, 10) == pytest.approx(18.30703805)


def test_walk_meets_points_in_order():
    rng = np.random.default_rng(5)
    points = rng.normal(size=(3_000, 8))
    tree, order = neighbours.Tree.grown(points)
    assert sorted(order.tolist()) == list(range(3_000)) and (tree.points == points[order]).all()
    place = rng.normal(size=8)
    gap = tree.points - place
    near = np.einsum("ij,ij->i", gap, gap)
    walk, met, distance = neighbours.Walk(tree, place), [], 0.0
    while (left := walk.least()) < math.inf:
        distance = max(distance * 1.1, left)
        shell = walk.shell(distance)
        assert sorted(shell.tolist()) == np.flatnonzero((near <= distance) & ~np.isin(np.arange(3_000), met)).tolist()
        met += shell.tolist()
    assert len(met) == 3_000


@pytest.mark.parametrize("noise, spread, share", [(0.02, 0, 0.2), (0.3, 0, 0.2), (0.02, 1, 0.2), (0.3, 1, 0.2)])
def test_share_verified_and_recall(noise, spread, share):
    """On vectors that lie in groups of more than k, a small share is verified, also where their lengths differ by far."""
    rng = np.random.default_rng(6)
    lengths = np.exp(spread * rng.normal(size=30_000))
    middles = rng.normal(size=(1_000, 64)) / 8
    vectors = (np.repeat(middles, 30, axis=0) + noise * rng.normal(size=(30_000, 64)) / 8) * lengths[:, None]
    block = neighbours.Block(np.arange(30_000), vectors, neighbours.projections(64, 16, 11), 20)
    quantile = neighbours.chi_square_quantile(0.95, 16)
    hits, asked = 0, range(0, 30_000, 600)
    for i in asked:
        scores = vectors @ vectors[i]
        scores[i] = -math.inf
        found = {j for _, j in block.search(vectors[i], i, 20, quantile)}
        hits += len(found & set(np.argsort(-scores)[:20].tolist()))
    print(noise, spread, len(block.trees), block.verified / block.asked / 30_000, hits / 20 / len(asked))
    assert hits / 20 / len(asked) >= 0.9
    assert block.verified / block.asked / 30_000 <= share


def test_block_files(tmp_path):
    rng = np.random.default_rng(8)
    ids, vectors = rng.integers(0, 400, 500), rng.normal(size=(500, 5)) * np.exp(rng.normal(size=(500, 1)))
    block = neighbours.Block(ids, vectors, neighbours.projections(5, 4, 1), 3)
    with open(tmp_path / "b.trees", "wb") as out:
        block.write(out)
    again = neighbours.Block.read(str(tmp_path / "b.trees"))
    for query in rng.normal(size=(20, 5)):
        assert again.search(query, 7, 3, 9.5) == block.search(query, 7, 3, 9.5)
