from __future__ import annotations

import random

import numpy as np
import pytest
from oracle import SF_DIR
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.queries import QUERIES


def invented(rng, n, extra=()):
    parts = ["an", "ti", "he", "re", "on", "or", "the", "ing", "ed", "st"]
    words = ["".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n)]
    for word in extra:
        words[rng.randrange(n)] = word
    return " ".join(words).encode()


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    bad = ["gnarlfush", "wobbletrot", "snidgrape"]
    toxic = [invented(rng, 150, rng.sample(bad, 2)) for _ in range(150)]
    return toxicity.fit(toxic, [invented(rng, 150) for _ in range(400)])


def test_marking_words_ignore_copies():
    rng = random.Random(2)
    same = invented(rng, 100)
    toxic = [same + b" oncemore"] * 60 + [invented(rng, 60, ["snidgrape"]) for _ in range(60)]
    found = toxicity.marking_words(toxic, [invented(rng, 100) for _ in range(200)])
    assert sorted(found) == [(b"snid", False), (b"snidgrape", True)]


def test_new_texts(model):
    rng = random.Random(3)
    scorer = toxicity.Scorer(model)
    bad = [scorer.score(invented(rng, 400, ["wobbletrot", "gnarlfush"])) for _ in range(100)]
    good = [scorer.score(invented(rng, 400)) for _ in range(100)]
    assert np.mean(np.array(bad) >= 0.3) > 0.9 and np.mean(np.array(good) >= 0.3) < 0.1
    late = invented(rng, 5_000) + b" WobbleTrot! snidgrape, gnarlfush"
    assert scorer.score(late) >= 0.3


def test_one_class_gives_the_share():
    assert toxicity.Scorer(toxicity.fit([], [])).score(b"x") == 0.0
    assert toxicity.Scorer(toxicity.fit([b"a b"] * 3, [])).score(b"x") == 1.0
    assert toxicity.Scorer(toxicity.fit([b"a b"], [b"a b"] * 3)).score(b"") == 0.25


def test_odd_rows(spark, odd, model):
    rows = toxicity.add_scores(odd.withColumn("score", F.lit("x")), model, ["doc_id", "found"]).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 and r.found == 2 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (0, 1, 2)}
    assert len(empty) == 1
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 1), (2, 1), (99, 0)], "doc_id long, toxic int")
    assert toxicity.train_model(odd, labels, F.lit(True)).ordinary is None
    assert toxicity.add_scores(odd.where("false"), model, ["doc_id"]).count() == 0


def test_held_out_labels(spark):
    scores = QUERIES["op10_toxicity"](spark, SF_DIR.replace("sf0.01", "sf0.1"))
    labels = spark.read.parquet(SF_DIR.replace("sf0.01", "sf0.1") + "/labels.parquet")
    rows = scores.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    bad = np.array([r.score for r in rows if r.toxic == 1])
    good = np.array([r.score for r in rows if r.toxic == 0])
    auc = np.mean(bad[:, None] > good) + np.mean(bad[:, None] == good) / 2
    print("AUC", auc, "found", np.mean(bad >= 0.3), "wrongly", np.mean(good >= 0.3))
    assert auc > 0.95 and np.mean(bad >= 0.3) > 0.85 and np.mean(good >= 0.3) < 0.05


def test_repeated_rows_and_labels_teach_what_one_does(spark):
    rng = random.Random(4)
    bad = ["gnarlfush", "wobbletrot", "snidgrape"]
    texts = [(i, invented(rng, 60, rng.sample(bad, 2) if i < 150 else ()).decode()) for i in range(450)]
    labels = [(i, int(i < 150)) for i in range(450)]
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    once = toxicity.train_model(frame(texts, "doc_id long, text string"), frame(labels, "doc_id long, toxic int"), F.lit(True))
    many = frame(texts + [texts[-1]] * 9_701 + [texts[0]] * 500, "doc_id long, text string")
    again = toxicity.train_model(many, frame(labels + [labels[0]] * 1_200 + [labels[-1]] * 3_000, "doc_id long, toxic int"), F.lit(True))
    assert once.toxic is not None and (once.ordinary, once.toxic) == (again.ordinary, again.toxic)
    assert np.array_equal(once.weights, again.weights)
    kept = toxicity.training_texts(many, frame(labels, "doc_id long, toxic int"), F.lit(True), 1_200, 3_600, 50_000)
    assert [len(k) for k in kept] == [150, 300]
