"""One weight per id: against a dense solver, beyond any number of hash slots, and with nulls."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tidemark.operators.bias import fit_biases
from tidemark.operators.metrics import roc_auc

SCHEMA = "u STRING, c INT, label INT"


def dense(rows, ridge):
    """(objective, weights by (field, id)) by Newton's method over all weights at once."""
    ids = sorted({(0, u) for u, _, _ in rows if u is not None}) + sorted({(1, c) for _, c, _ in rows if c is not None})
    at = {x: i for i, x in enumerate(ids)}
    x, y = np.zeros((len(rows), len(ids))), np.array([r[2] for r in rows], float)
    for i, (u, c, _) in enumerate(rows):
        for known in ((0, u), (1, c)):
            if known in at:
                x[i, at[known]] = 1
    w = np.zeros(len(ids))
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(w)), x.T @ (p - y) + ridge * w)
    z = x @ w
    return float(np.sum(np.logaddexp(0, z) - y * z) + ridge / 2 * w @ w), dict(zip(ids, w))


def skewed(n, nulls=False):
    rnd, rows = random.Random(5), []
    for _ in range(n):
        u, c = f"u{int(rnd.paretovariate(0.7)) % 50}", rnd.randrange(20) if rnd.random() < 0.6 else 0
        odds = (int(u[1:]) % 5 - 2) + (c % 3 - 1)
        row = (u, c, int(rnd.random() < 1 / (1 + math.exp(-odds))))
        rows.append((None if nulls and rnd.random() < 0.1 else row[0], None if nulls and rnd.random() < 0.1 else row[1], row[2]))
    return rows


@pytest.mark.parametrize("nulls", [False, True])
@pytest.mark.parametrize("ridge", [1.0, 0.05])
def test_equals_a_dense_solver(spark, ridge, nulls):
    rows = skewed(800, nulls)
    model = fit_biases(spark.createDataFrame(rows, SCHEMA), ["u", "c"], "label", ridge, tolerance=1e-8)
    want, weights = dense(rows, ridge)
    assert list(model.objective) == sorted(model.objective, reverse=True)
    assert model.objective[-1] == pytest.approx(want, rel=1e-5) and model.objective[-1] >= want - 1e-6
    for field, held in enumerate(model.weights):
        got = {(field, r["id"]): r["weight"] for r in held.collect()}
        assert got.keys() == {k for k in weights if k[0] == field}
        assert max(abs(got[k] - weights[k]) for k in got) < 0.05


def test_more_ids_than_hash_slots(spark):
    """300 000 users, more than 2**18: each has the sign of its own labels."""
    rows = spark.range(300_000 * 3).selectExpr("id % 300000 AS u", "CAST(id % 7 AS INT) AS c", "CAST(id % 300000 % 2 AS INT) AS label")
    model = fit_biases(rows, ["u", "c"], "label", passes=3)
    held = model.weights[0]
    assert held.count() == 300_000
    assert held.where("(weight > 0) != (id % 2 = 1)").isEmpty()
    assert model.score(rows).where("prediction != label").isEmpty()


def test_scores(spark):
    rows = [(f"u{i % 10}", i % 7, int(i % 10 < 5)) for i in range(700)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", weight STRING")
    scored = fit_biases(df, ["u", "c"], "label").score(df)
    assert scored.columns == [*df.columns, "score", "prediction"]
    assert roc_auc(scored, "score", "label").first()["roc_auc"] > 0.99
    unknown = spark.createDataFrame([("new", 99, 1), (None, None, 0)], SCHEMA)
    assert {r["score"] for r in fit_biases(df, ["u", "c"], "label").score(unknown).collect()} == {0.5}


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([("a", 1, None)], SCHEMA)
    assert fit_biases(none, ["u", "c"], "label").weights[0].count() == 0
