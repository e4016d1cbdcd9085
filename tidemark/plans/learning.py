"""Spark ML baselines on the provided tables. No SQL twin exists; tests check them against known behaviour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import models
from tidemark.operators.bias import fit_biases
from tidemark.operators.indexing import index_interactions
from tidemark.operators.metrics import f1_sweep, training_report
from tidemark.operators.sampling import balanced_weights, exact_sample
from tidemark.plans.registry import query
from tidemark.session import scratch_path
from tidemark.sources.tables import interactions, table

FEATURES = ["n_chars", "n_words", "n_lines", "commas", "english"]


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with simple numeric features and an exact stratified test part."""
    rows = (
        table(spark, sf_dir, "documents")
        .join(table(spark, sf_dir, "labels"), "doc_id")
        .selectExpr(
            "doc_id",
            "quality AS label",
            "n_chars",
            "size(split(text, ' ')) AS n_words",
            "size(split(text, '\\n')) AS n_lines",
            "size(split(text, ',')) AS commas",
            "CAST(lang = 'en' AS INT) AS english",
        )
    )
    return exact_sample(rows, "doc_id", fraction=0.2, by="label", flag="test")


def trained(spark: SparkSession, sf_dir: str):
    rows = balanced_weights(examples(spark, sf_dir), "label")
    model = models.boosted_trees(
        rows, FEATURES, "label", weight="weight", validation="test", maxIter=10, stepSize=0.1
    )
    return rows, model


@query("gbt_score")
def gbt_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted boosted trees, saved, loaded again and applied to the test part."""
    rows, model = trained(spark, sf_dir)
    path = scratch_path(spark, "model")
    models.save(model, path)
    return models.score(models.load(path), rows.where("test")).select("doc_id", "label", "score", "prediction")


@query("gbt_report")
def gbt_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_report(gbt_score(spark, sf_dir), "score", "label")


@query("gbt_importance")
def gbt_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.top_features(spark, trained(spark, sf_dir)[1], FEATURES)


def strengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = index_interactions(interactions(spark, sf_dir), "user_id", "k")
    return (
        rows.groupBy("user_index", "creator_index")
        .agg(F.sum("value").alias("strength"))
        .selectExpr("CAST(user_index AS INT) AS user_index", "CAST(creator_index AS INT) AS creator_index", "strength")
    )


@query("als_factors")
def als_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    users, items = models.factor_model(
        strengths(spark, sf_dir), "user_index", "creator_index", "strength", rank=8, iterations=5
    )
    return users.withColumn("side", F.lit("user")).unionByName(items.withColumn("side", F.lit("creator")))


def bias_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(spark, sf_dir).selectExpr("event_id", "user_id", "k", "CAST(value > 50 AS INT) AS label")


@query("bias_lr")
def bias_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weight per user and per creator."""
    rows = bias_rows(spark, sf_dir)
    return fit_biases(rows, ["user_id", "k"], "label").score(rows).select("event_id", "label", "score")


@query(
    "bias_balance",
    """
WITH e AS (SELECT user_id, CAST(props->>'$.k' AS INTEGER) AS k, CAST(value > 50 AS INTEGER) AS label FROM events)
SELECT 'user' AS side, CAST(user_id AS BIGINT) AS id, CAST(sum(label) AS BIGINT) AS positives FROM e GROUP BY user_id
UNION ALL
SELECT 'creator', CAST(k AS BIGINT), CAST(sum(label) AS BIGINT) FROM e GROUP BY k""",
)
def bias_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds at the minimum alone: an id's scores and its ridge times its weight add up to its positives."""
    rows, ridge = bias_rows(spark, sf_dir), 1.0
    model = fit_biases(rows, ["user_id", "k"], "label", ridge)
    scored = rows.join(model.score(rows).select("event_id", "score"), "event_id")
    sides = []
    for side, field, weights in zip(("user", "creator"), model.fields, model.weights):
        sums = scored.groupBy(F.col(field).cast("bigint").alias("id")).agg(F.sum("score").alias("total"))
        held = sums.join(weights.select(F.col("id").cast("bigint").alias("id"), "weight"), "id")
        sides.append(held.selectExpr(f"'{side}' AS side", "id", f"CAST(round(total + {ridge} * weight) AS BIGINT) AS positives"))
    return sides[0].unionByName(sides[1])


@query("text_lr")
def text_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text classifier trained on four fifths, its F1 at every threshold on the rest."""
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    rows = exact_sample(
        rows.selectExpr("doc_id", "text", "toxic AS label"), "doc_id", fraction=0.2, by="label", flag="test"
    )
    model = models.text_classifier(rows.where("NOT test"), "text", "label")
    return f1_sweep(models.score(model, rows.where("test")), "score", "label")
