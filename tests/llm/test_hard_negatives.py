from __future__ import annotations

import math

import numpy as np
import pytest
from oracle import SF_DIR
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int"


def sample(n, d, seed=1):
    return np.floor(256 * np.random.default_rng(seed).normal(size=(n, d)) / math.sqrt(d)).astype(np.int64)


@pytest.mark.parametrize("d", [1, 3, 64, 100])
@pytest.mark.parametrize("bits, planes", [(64, 2), (1024, 6)])
def test_intervals_hold_every_product(d, bits, planes):
    rows, asked = sample(2000, d), sample(20, d, seed=2)
    rows[:10], rows[10:20], asked[0] = 0, asked[:10], 0
    matrix = hn.rotations(d, bits, 5)
    codes, queries = hn.encode(rows.astype(float), matrix), hn.Queries(asked, matrix, planes)
    ones = np.bitwise_count(codes.words).sum(axis=1, dtype=np.int64)
    for i, q in enumerate(asked):
        least, most = queries.intervals(i, codes, ones)
        assert (least <= rows @ q).all() and (rows @ q <= most).all()


def brute(rows, band=(80, 100, 100)):
    """Rows are (id, vector, label) that take part, one an id."""
    ints = {i: [math.floor(256 * x) for x in v] for i, v, _ in rows}
    labels = {i: c for i, _, c in rows}
    found = []
    for a in (i for i in ints if i % 100 == 0):
        scores = {o: sum(x * y for x, y in zip(ints[a], v)) for o, v in ints.items() if o != a and len(v) == len(ints[a])}
        ranked = sorted(scores, key=lambda o: (-scores[o], o))
        for p in [o for o in ranked if labels[o] == labels[a]][:5]:
            fit = [o for o in ranked if labels[o] != labels[a] and band[0] * scores[p] <= band[2] * scores[o] <= band[1] * scores[p]]
            found += [(a, p, rank, o, scores[p], scores[o]) for rank, o in enumerate(fit[:5], 1)]
    return sorted(found)


def found(frame, **settings):
    return sorted(map(tuple, hn.hard_negatives(frame, F.col("id") % 100 == 0, **settings).collect()))


@pytest.mark.parametrize("settings", [{}, {"bits": 64, "planes": 2}, {"block_rows": 1}])
def test_equals_brute_force(spark, settings):
    r = np.random.default_rng(3)
    values = r.normal(size=(900, 16)).astype(np.float32) / 4
    values[100:160] = values[0]  # ties with an anchor and with one another
    rows = [(i, values[i].tolist(), int(r.integers(0, 4))) for i in range(900)]
    assert found(spark.createDataFrame(rows, SCHEMA), **settings) == brute(rows)


def test_odd_rows(spark):
    good = [
        (0, [0.5, 0.5], 1),
        (1, [0.5, 0.25], 1),
        (2, [0.5, 0.2], 2),
        (3, [0.5, 0.2], 2),
        (4, [-0.5, -0.25], 1),
        (5, [0.0, 0.0], 1),
        (6, [0.0, -0.0], 3),
        (100, [0.25], 1),
        (101, [0.25], 1),
        (102, [0.125], 2),
        (-100, [0.5, 0.5], 2),
        (200, [0.0, 0.0], 9),
        (300, [1.0, 1.0], 9),
    ]
    bad = [
        (10, None, 1),
        (11, [0.5, None], 1),
        (12, [0.5, math.inf], 1),
        (13, [0.5, math.nan], 1),
        (14, [0.5, 0.5], None),
        (15, [], 1),
        (None, [0.5, 0.5], 1),
        (16, [1e30, 1.0], 2),
        (2, [0.5, 0.2], 7),  # an id that stands for the row above
    ]
    frame = spark.createDataFrame([(*r, "x", 1) for r in (*good, *bad, *good)], SCHEMA + ", code string, part int")
    assert found(frame) == brute(good)
    assert found(frame.limit(0)) == []


def test_intervals_leave_most_rows_unscored(spark):
    """On vectors without any structure, the codes alone rule out most rows."""
    values = sample(20_000, 64, seed=4)
    codes = hn.encode(values.astype(float), hn.rotations(64, hn.BITS, 17))
    block = hn.Block(np.arange(20_000), (np.arange(20_000) % 10).astype(str).astype(object), values, codes)
    queries = hn.Queries(values[:20], hn.rotations(64, hn.BITS, 17), hn.PLANES)
    for i in range(20):
        near = block.positives(queries, i, values[i], i, str(i % 10), 5)
        block.negatives(queries, i, values[i], str(i % 10), [(-(-80 * s // 100), s) for s, _ in near], 5)
    assert block.scored < 0.15 * block.seen


def test_shares_of_the_given_table(spark):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
