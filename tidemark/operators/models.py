"""Spark ML baselines behind the ranking jobs: training, scoring, importances, factors. Weights per id are in ``bias``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path, scratch_root

# Training settings of the ranking jobs
RANKER = {"maxDepth": 2, "stepSize": 0.01, "maxIter": 2000}
CLASSIFIER = {"maxDepth": 7, "stepSize": 0.015, "maxIter": 200}
TOP_FEATURES = 20


def boosted_trees(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    weight: str | None = None,
    validation: str | None = None,
    seed: int = 42,
    **settings,
) -> PipelineModel:
    """Gradient-boosted trees; ``validation`` names a boolean column whose rows decide when to stop early."""
    scratch_root(train.sparkSession)  # the trainer cuts its lineage there
    trees = GBTClassifier(
        featuresCol="features", labelCol=label, seed=seed, checkpointInterval=10, **{**RANKER, **settings}
    )
    if weight:
        trees = trees.setWeightCol(weight)
    if validation:
        trees = trees.setValidationIndicatorCol(validation)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    return Pipeline(stages=[assembler, trees]).fit(train)


def score(model: PipelineModel, rows: DataFrame, name: str = "score", threshold: float = 0.5) -> DataFrame:
    """``rows`` plus the positive-class probability and the prediction at ``threshold``."""
    kept = [c for c in rows.columns if c != name]
    scored = model.transform(rows).withColumn(name, vector_to_array("probability")[1])
    return scored.select(*kept, name, (F.col(name) >= threshold).cast("int").alias("prediction"))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def _without_summary(model: PipelineModel) -> PipelineModel:
    """The stored model: a fresh logistic regression also holds its session, which tasks may not be sent."""
    path = scratch_path(SparkSession.active(), "model")
    save(model, path)
    return load(path)


def top_features(spark: SparkSession, model: PipelineModel, features: Sequence[str], n: int = TOP_FEATURES) -> DataFrame:
    """(feature, importance), the largest ``n``; the list is as long as the feature list."""
    importances = model.stages[-1].featureImportances.toArray().tolist()
    rows = spark.createDataFrame(list(zip(features, importances)), "feature STRING, importance DOUBLE")
    return rows.orderBy(F.desc("importance"), "feature").limit(n)


def factor_model(
    rows: DataFrame, user: str, item: str, strength: str, rank: int = 64, iterations: int = 10, seed: int = 42
):
    """Implicit-feedback factorisation; ids are dense integer indexes. Returns (user factors, item factors)."""
    scratch_root(rows.sparkSession)
    als = ALS(
        userCol=user,
        itemCol=item,
        ratingCol=strength,
        rank=rank,
        maxIter=iterations,
        implicitPrefs=True,
        seed=seed,
        checkpointInterval=5,
    )
    model = als.fit(rows)
    return tuple(
        factors.select("id", F.col("features").cast("array<double>").alias("features"))
        for factors in (model.userFactors, model.itemFactors)
    )


def text_classifier(rows: DataFrame, text: str, label: str, buckets: int = 1 << 16) -> PipelineModel:
    """Hashed words, weighted by rarity, into a logistic regression."""
    stages = [
        RegexTokenizer(inputCol=text, outputCol="words", pattern=r"\W+"),
        HashingTF(inputCol="words", outputCol="counts", numFeatures=buckets),
        IDF(inputCol="counts", outputCol="features"),
        LogisticRegression(labelCol=label, maxIter=20, regParam=0.01),
    ]
    return _without_summary(Pipeline(stages=stages).fit(rows))
