"""Running totals, quantiles, indexes and exact samples against numpy and plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions.hashing import portable_hash
from tidemark.operators import metrics as M
from tidemark.operators import sampling
from tidemark.operators.indexing import index_interactions
from tidemark.operators.running import Ranges, dense_index, exact_quantiles, ranged, running_totals
from tidemark.operators.sampling import balanced_weights, downsample_negatives, exact_sample

NARROW = Ranges(rows_per_range=7)


@pytest.mark.parametrize("ranges", [Ranges(), NARROW, Ranges(rows_per_range=1), Ranges(rows_per_range=7, fan=4)])
def test_running_totals(spark, ranges):
    rnd = random.Random(4)
    # a third of the values lies in a tiny interval
    values = sorted({rnd.random() * (1e-6 if i % 3 == 0 else 100) for i in range(900)})
    rows = [(v, rnd.randrange(5)) for v in values]
    df = spark.createDataFrame(rows, "v DOUBLE, n INT")
    got = {r["v"]: (r["cum_n"], r["total_n"]) for r in running_totals(df, "v", ["n"], ranges=ranges).collect()}
    total = 0
    whole = sum(n for _, n in rows)
    for v, n in rows:
        total += n
        assert got[v] == (total, whole)


@pytest.mark.parametrize("fan", [2, 4])
def test_no_range_grows_where_a_level_has_few_parts(spark, fan):
    """20 000 rows in ranges of 100 from levels of few parts: as even as from one level, and in order."""
    rows = spark.range(20_000).selectExpr("IF(id < 100, id * 1D, 1000 + id / 1e6) AS v")
    cut = ranged(rows, 20_000, "v", Ranges(rows_per_range=100, fan=fan)).groupBy("_range")
    found = cut.agg({"v": "min"}).join(cut.count(), "_range").orderBy("_range").toDF("range", "low", "n").collect()
    assert len(found) > 150 and max(r["n"] for r in found) < 400
    assert [r["low"] for r in found] == sorted(r["low"] for r in found)


@pytest.mark.parametrize("ranges", [NARROW, Ranges(rows_per_range=3, fan=2)])
def test_running_totals_by_group(spark, ranges):
    rows = [(g, v, 1) for g in "ab" for v in range(100 if g == "a" else 30)]
    df = spark.createDataFrame(rows, "g STRING, v INT, n INT")
    got = running_totals(df, "v", ["n"], by=["g"], ranges=ranges).collect()
    assert {(r["g"], r["v"]): (r["cum_n"], r["total_n"]) for r in got} == {
        (g, v): (v + 1, 100 if g == "a" else 30) for g, v, _ in rows
    }


def test_quantiles(spark):
    rnd = np.random.default_rng(0)
    values = np.concatenate([np.full(300, 5.0), rnd.normal(size=650)])  # one value holds a third of all rows
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v DOUBLE")
    got = exact_quantiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0], ranges=NARROW).first()
    assert list(got) == pytest.approx(list(np.quantile(values, [0.0, 0.25, 0.5, 0.9, 1.0])))


def test_dense_index_of_text(spark):
    words = [f"id-{i * 37 % 501:05d}" for i in range(501)] * 2 + [None]
    df = spark.createDataFrame([(w,) for w in words], "w STRING")
    got = {r["w"]: r["i"] for r in dense_index(df, "w", "i", NARROW).collect()}
    assert got == {w: i for i, w in enumerate(sorted({w for w in words if w}))}


def test_creators_are_numbered_after_the_user_cap(spark):
    rows = [("u0", "c9"), ("u1", "c5"), ("u2", "c1"), ("u0", "c7")]
    df = spark.createDataFrame(rows, "user STRING, creator STRING")
    got = {(r["user"], r["creator"]): (r["user_index"], r["creator_index"])
           for r in index_interactions(df, "user", "creator", cap=1).collect()}
    assert got == {("u0", "c9"): (0, 2), ("u1", "c5"): (1, 0), ("u0", "c7"): (0, 1)}


def scores(spark, rows):
    return spark.createDataFrame([(float(s), int(y)) for s, y in rows], "s DOUBLE, y INT")


def pairwise_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return won / (len(pos) * len(neg)) if pos and neg else None


def step_ap(rows):
    out, positives = 0.0, sum(y for _, y in rows)
    for t in sorted({s for s, _ in rows}, reverse=True):
        tp = sum(y for s, y in rows if s >= t)
        out += sum(y for s, y in rows if s == t) / positives * tp / sum(s >= t for s, _ in rows)
    return out


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([0.1, 0.2, 0.3, 0.7, 0.9]), st.integers(0, 1)), min_size=2, max_size=30))
def test_auc_and_ap(spark, rows):
    df = scores(spark, rows)
    want = pairwise_auc(rows)
    for ranges in (Ranges(), Ranges(rows_per_range=1)):
        got = M.roc_auc(df, "s", "y", ranges).first()["roc_auc"]
        assert got is None if want is None else got == pytest.approx(want)
        if any(y for _, y in rows):
            assert M.average_precision(df, "s", "y", ranges).first()[0] == pytest.approx(step_ap(rows))


def test_ties_and_perfect_ranking(spark):
    assert M.roc_auc(scores(spark, [(1, 0), (1, 1), (1, 1)]), "s", "y").first()["roc_auc"] == 0.5
    perfect = scores(spark, [(0.1, 0), (0.2, 0), (0.8, 1), (0.9, 1)])
    assert M.roc_auc(perfect, "s", "y").first()["roc_auc"] == 1.0
    assert M.average_precision(perfect, "s", "y").first()[0] == 1.0


def test_f1_sweep_has_twenty_thresholds(spark):
    out = M.f1_sweep(scores(spark, [(0.0, 0), (0.5, 1), (1.0, 1)]), "s", "y").orderBy("threshold").collect()
    assert [r["threshold"] for r in out] == [i / 20 for i in range(20)]
    assert out[0]["f1"] == pytest.approx(0.8)
    assert out[11]["f1"] == pytest.approx(2 / 3)


def test_roc_points_start_at_the_origin(spark):
    got = M.roc_points(scores(spark, [(0.2, 0), (0.8, 1)]), "s", "y").orderBy("fpr", "tpr").collect()
    assert [(r["fpr"], r["tpr"]) for r in got] == [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]


@pytest.mark.parametrize("fraction", [0.0, 0.2, 0.75, 1.0])
def test_exact_fraction(spark, fraction):
    df = spark.range(1000)
    assert exact_sample(df, "id", fraction=fraction).where("in_sample").count() == fraction * 1000


def test_exact_count_per_class(spark):
    df = spark.range(997).selectExpr("id", "CASE WHEN id % 7 = 0 THEN 'rare' ELSE 'hot' END AS c")
    got = {r["c"]: r["count"] for r in exact_sample(df, "id", n=50, by="c").where("in_sample").groupBy("c").count().collect()}
    assert got == {"rare": 50, "hot": 50}
    again = exact_sample(df.repartition(13), "id", n=50, by="c").where("in_sample")
    assert again.exceptAll(exact_sample(df, "id", n=50, by="c").where("in_sample")).count() == 0


def test_more_negatives_asked_than_there_are(spark):
    df = spark.range(30).selectExpr("id", "CAST(id % 3 = 0 AS INT) AS label")
    assert downsample_negatives(df, "label", "id", 1000).count() == 30


def test_weights_balance_the_classes(spark):
    df = spark.range(40).selectExpr("id", "CAST(id % 4 = 0 AS INT) AS label")
    got = {r["label"]: r["w"] for r in balanced_weights(df, "label").groupBy("label").agg({"weight": "sum"}).toDF("label", "w").collect()}
    assert got == {0: pytest.approx(20), 1: pytest.approx(20)}


def test_portable_hash(spark):
    import hashlib

    from pyspark.sql import functions as F

    got = spark.range(3).select(portable_hash(F.col("id"), 42).alias("h")).collect()
    assert [r["h"] for r in got] == [int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16) for i in range(3)]


@pytest.mark.parametrize("bits", [2, 5])
def test_the_cut_bucket_is_refined_until_it_is_small(spark, monkeypatch, bits):
    monkeypatch.setattr(sampling, "BUCKET_BITS", bits)
    df = spark.range(5_000).selectExpr("id", "IF(id % 10 = 0, 'few', 'many') AS c")
    hashed = df.selectExpr("c", "id AS _key").withColumn("_h", portable_hash(F.col("_key"), 42))
    cut, used = sampling._cut_bucket(hashed, "100", ["c"], 20)
    assert used > bits and {r["c"]: r["n"] <= 20 for r in cut.collect()} == {"few": True, "many": True}
    for kind in ({"n": 100}, {"fraction": 0.3}):
        small = exact_sample(df, "id", by="c", ranked_rows=20, **kind)
        whole = exact_sample(df, "id", by="c", **kind)
        assert small.exceptAll(whole).isEmpty()
        sizes = {r["c"]: r["count"] for r in small.where("in_sample").groupBy("c").count().collect()}
        assert sizes == ({"few": 100, "many": 100} if "n" in kind else {"few": 150, "many": 1350})
    assert exact_sample(df, "id", n=777, ranked_rows=3).where("in_sample").count() == 777
    assert exact_sample(df, "id", n=9_999, ranked_rows=3).where("in_sample").count() == 5_000
    assert exact_sample(df, "id", n=0, ranked_rows=3).where("in_sample").count() == 0
