"""Half-steps from given factors against dense algebra; export in index order."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import factors as fa


def example(spark, users=30, items=20, k=4, n=300, seed=3):
    r = np.random.default_rng(seed)
    rows = [(f"u{int(u)}", int(i), float(s)) for u, i, s in zip(r.integers(0, users, n), r.integers(0, items, n), r.normal(2, 2, n))]
    rows += [("u0", i, 1.0) for i in range(items) for _ in range(3)]  # an id with many rows
    x = {f"u{u}": r.normal(size=k) for u in range(users - 5)}  # five users are new
    y = {i: r.normal(size=k) for i in range(items + 3)}  # three items do not interact
    strengths = fa.Strengths(spark.createDataFrame(rows, "u STRING, i INT, s DOUBLE"), "u", "i", "s", alpha=0.7, reg=0.3)
    frame = lambda held, kind: spark.createDataFrame([(k, v.tolist()) for k, v in held.items()], f"id {kind}, features ARRAY<DOUBLE>")
    return rows, x, y, strengths, frame(x, "STRING"), frame(y, "INT")


def summed(rows):
    pairs = {}
    for u, i, s in rows:
        pairs[u, i] = pairs.get((u, i), 0.0) + s
    return pairs


def dense_step(pairs, y, alpha, reg):
    k = len(next(iter(y.values())))
    g = sum(np.outer(v, v) for v in y.values())
    found = {}
    for u in {u for u, _ in pairs}:
        a, b = g + reg * np.eye(k), np.zeros(k)
        for (own, i), s in pairs.items():
            if own == u:
                a = a + alpha * abs(s) * np.outer(y[i], y[i])
                b = b + (1 + alpha * abs(s)) * (s > 0) * y[i]
        found[u] = np.linalg.solve(a, b)
    return found


def dense_loss(pairs, x, y, alpha, reg):
    total = reg * (sum(v @ v for v in x.values()) + sum(v @ v for v in y.values()))
    for u in {*x, *(u for u, _ in pairs)}:
        for i in y:
            s, g = pairs.get((u, i), 0.0), x[u] @ y[i] if u in x else 0.0
            total += (1 + alpha * abs(s)) * ((s > 0) - g) ** 2
    return total


@pytest.mark.parametrize("rows_per_part", [3, 100_000])
def test_half_step_solves_the_normal_equations(spark, rows_per_part):
    rows, _, y, strengths, _, items = example(spark)
    got = {r["id"]: r["features"] for r in fa.half_step(strengths, "u", "i", items, rows_per_part).collect()}
    want = dense_step(summed(rows), y, 0.7, 0.3)
    assert got.keys() == want.keys()
    for u, features in want.items():
        assert got[u] == pytest.approx(features.tolist(), rel=1e-9, abs=1e-12)


def test_loss_falls_in_each_half_step(spark):
    rows, x, y, strengths, users, items = example(spark)
    assert fa.loss(strengths, users, items) == pytest.approx(dense_loss(summed(rows), x, y, 0.7, 0.3))
    losses = [fa.loss(strengths, *fa.refit(strengths, users, items, n)) for n in range(5)]
    assert all(a > b for a, b in zip(losses, losses[1:]))
    warm_users, warm_items = fa.refit(strengths, users, items, 2)
    kept = {r["id"]: r["features"] for r in warm_items.collect()}
    assert kept.keys() == y.keys() and [kept[i] for i in (20, 21, 22)] == [y[i].tolist() for i in (20, 21, 22)]
    assert {r["id"] for r in warm_users.collect()} == {f"u{u}" for u in range(30)}


def test_null_ids_and_strengths_do_not_count(spark):
    rows, _, _, strengths, _, items = example(spark, n=50)
    odd = strengths.rows.unionByName(spark.createDataFrame([(None, 1, 1.0), ("u1", None, 1.0), ("u1", 1, None)], strengths.rows.schema))
    clean = {r["id"]: r["features"] for r in fa.half_step(strengths, "u", "i", items).collect()}
    found = {r["id"]: r["features"] for r in fa.half_step(fa.Strengths(odd, "u", "i", "s", 0.7, 0.3), "u", "i", items).collect()}
    assert found.keys() == clean.keys() and all(found[u] == pytest.approx(clean[u]) for u in clean)
    none = fa.Strengths(strengths.rows.limit(0), "u", "i", "s")
    assert fa.half_step(none, "u", "i", items).count() == 0


@pytest.mark.parametrize("rows_per_file", [7, 10, 1000])
def test_export_is_in_index_order(spark, tmp_path, rows_per_file):
    rows = spark.range(100).select((F.lit(99) - F.col("id")).alias("index"), F.array(F.col("id").cast("double")).alias("v")).repartition(5)
    manifest = fa.export_in_order(rows, "index", str(tmp_path), rows_per_file).orderBy("file").collect()
    assert [(m.first_index, m.n_rows) for m in manifest] == [(a, min(rows_per_file, 100 - a)) for a in range(0, 100, rows_per_file)]
    back = fa.read_in_order(spark, str(tmp_path), "index BIGINT, v ARRAY<DOUBLE>").collect()
    assert len(back) == 100 and all(r.position == r["index"] and r.v == [99.0 - r["index"]] for r in back)
    assert fa.export_in_order(rows.limit(0), "index", str(tmp_path / "none")).count() == 0


def test_refit_query_sums_vectors_not_cells(spark, tmp_path):
    """The left-hand sides are the right-hand ones, and no pair is taken apart into a row for each of its products."""
    from tidemark.plans.preparation import DIM, factor_refit

    r = np.random.default_rng(5)
    y = {i: r.normal(size=DIM).astype("float32").tolist() for i in range(30)}
    events = [(e, e % 7, float(v), f'{{"k": {k}}}') for e, (v, k) in enumerate(zip(r.normal(50, 60, 400), r.integers(0, 35, 400)))]
    rows = spark.createDataFrame(events, "event_id BIGINT, user_id BIGINT, value DOUBLE, props STRING")
    rows.selectExpr("*", "TIMESTAMP_NTZ '2024-01-01' AS ts", "'view' AS event_type").write.parquet(f"{tmp_path}/events.parquet")
    vectors = spark.createDataFrame(list(y.items()), "vec_id BIGINT, embedding ARRAY<FLOAT>")
    vectors.write.parquet(f"{tmp_path}/embeddings.parquet")
    sides = factor_refit(spark, str(tmp_path))
    want = {u: np.zeros(DIM) for u in range(7)}
    for (u, k), s in summed([(e[1], int(e[3][6:-1]), e[2] / 100) for e in events]).items():
        want[u] += (s > 0) * (1 + 0.5 * s) * np.array(y.get(k, [0.0] * DIM))
    got = {row["user_id"]: [row[f"b{i}"] for i in range(DIM)] for row in sides.collect()}
    assert got.keys() == want.keys() and all(got[u] == pytest.approx(want[u].tolist(), abs=2e-5) for u in want)
    assert "posexplode(transform(" not in sides._jdf.queryExecution().optimizedPlan().toString()
