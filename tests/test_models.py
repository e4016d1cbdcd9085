"""Spark ML baselines: they learn what there is to learn, and survive a reload."""

from __future__ import annotations

import random

import pytest

from tidemark.operators import models
from tidemark.operators.metrics import roc_auc

# The two rows scored by the live and by the reloaded model
COLUMNS = ["gift", "seat", "comment", "join", "chatroom_gift"]
ROWS = [(10, 0, 10, 5, 5), (20, 1, 0, 1, 0)]


@pytest.fixture(scope="module")
def examples(spark):
    rnd = random.Random(0)
    rows = []
    for i in range(400):
        values = [rnd.randrange(30) for _ in COLUMNS]
        rows.append((*values, int(values[0] + values[2] > 25), i % 4 == 0))
    return spark.createDataFrame(rows, [*COLUMNS, "label", "held_out"])


def test_boosted_trees_reload(spark, examples, tmp_path):
    model = models.boosted_trees(examples, COLUMNS, "label", validation="held_out", maxIter=8, stepSize=0.3)
    scored = models.score(model, examples)
    assert roc_auc(scored, "score", "label").first()["roc_auc"] > 0.9
    models.save(model, str(tmp_path / "m"))
    two = spark.createDataFrame(ROWS, COLUMNS)
    live = [r["score"] for r in models.score(model, two).collect()]
    again = [r["score"] for r in models.score(models.load(str(tmp_path / "m")), two).collect()]
    assert live == again
    top = [r["feature"] for r in models.top_features(spark, model, COLUMNS, 2).collect()]
    assert set(top) == {"gift", "comment"}


def test_factor_model_prefers_what_was_used(spark):
    rows = [(u, i, 5.0) for u in range(12) for i in range(8) if u % 2 == i % 2]
    users, items = models.factor_model(
        spark.createDataFrame(rows, "u INT, i INT, s DOUBLE"), "u", "i", "s", rank=4, iterations=5
    )
    u = {r["id"]: r["features"] for r in users.collect()}
    v = {r["id"]: r["features"] for r in items.collect()}

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    assert min(dot(u[a], v[b]) for a, b, _ in rows) > max(dot(u[a], v[b]) for a in u for b in v if a % 2 != b % 2)


def test_text_classifier(spark):
    rows = [(f"good kind word{i % 5}" if i % 2 else f"bad rude word{i % 5}", i % 2) for i in range(100)]
    df = spark.createDataFrame(rows, "text STRING, label INT")
    scored = models.score(models.text_classifier(df, "text", "label"), df)
    assert scored.where("prediction <> label").count() == 0
