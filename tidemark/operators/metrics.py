"""Exact classification metrics.

Ranking metrics first collapse rows to one per distinct score, so ties are
handled exactly and a score shared by many rows is one row before any window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.running import Ranges, running_totals

SWEEP_STEPS = 20  # fixed value: thresholds 0, 0.05, … 0.95
PROBABILITY_FLOOR = 1e-7  # fixed value: log-loss clips probabilities to [floor, 1 - floor]


def _by_score(rows: DataFrame, score: str, label: str, ranges: Ranges) -> DataFrame:
    """One row per score: positives and negatives at it, and running totals from the lowest score up."""
    grouped = (
        rows.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    return running_totals(grouped, "score", ["pos", "neg"], ranges=ranges)


ROC_AUC = "try_divide(sum(CAST(pos AS DOUBLE) * (cum_neg - neg + neg / 2D)), CAST(sum(pos) AS DOUBLE) * sum(neg))"
TP, FP = "(total_pos - cum_pos + pos)", "(total_neg - cum_neg + neg)"
AVERAGE_PRECISION = f"sum(try_divide(pos, total_pos) * {TP} / ({TP} + {FP}))"


def roc_auc(rows: DataFrame, score: str, label: str, ranges: Ranges = Ranges()) -> DataFrame:
    """One row: area under the ROC curve, positives, negatives. Null where one class is missing."""
    return _by_score(rows, score, label, ranges).agg(
        F.expr(ROC_AUC).alias("roc_auc"), F.sum("pos").alias("positives"), F.sum("neg").alias("negatives")
    )


def roc_points(rows: DataFrame, score: str, label: str, ranges: Ranges = Ranges()) -> DataFrame:
    """Every point of the ROC curve, from (0, 0) at an infinite threshold on."""
    points = _by_score(rows, score, label, ranges).selectExpr(
        "score AS threshold", f"try_divide({FP}, total_neg) AS fpr", f"try_divide({TP}, total_pos) AS tpr"
    )
    origin = rows.sparkSession.range(1).selectExpr("double('inf') AS threshold", "0D AS fpr", "0D AS tpr")
    return points.unionByName(origin)


def pr_points(rows: DataFrame, score: str, label: str, ranges: Ranges = Ranges()) -> DataFrame:
    """Every point of the precision-recall curve."""
    return _by_score(rows, score, label, ranges).selectExpr(
        "score AS threshold", f"{TP} / ({TP} + {FP}) AS precision", f"try_divide({TP}, total_pos) AS recall"
    )


def average_precision(rows: DataFrame, score: str, label: str, ranges: Ranges = Ranges()) -> DataFrame:
    """One row: sum over thresholds of the recall step times the precision there."""
    return _by_score(rows, score, label, ranges).agg(F.expr(AVERAGE_PRECISION).alias("average_precision"))


def calibration(rows: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean score and share of positives per uniform bin [i/bins, (i+1)/bins); 1.0 joins the last, empty bins are absent.

    Rows with a null score belong to no bin.
    """
    rows = rows.where(F.col(score).isNotNull())
    place = F.least(F.floor(F.col(score) * bins), F.lit(bins - 1)).alias("bin")
    return rows.groupBy(place).agg(
        F.avg(score).alias("mean_score"),
        F.avg(F.col(label).cast("double")).alias("positive_share"),
        F.count(F.lit(1)).alias("count"),
    )


def f1_sweep(rows: DataFrame, score: str, label: str, steps: int = SWEEP_STEPS) -> DataFrame:
    """F1 of ``score >= threshold`` at thresholds i/steps, i = 0 … steps-1, in one pass."""
    cells = [F.expr(f"count_if(`{label}` = 1) AS positives")]
    for i in range(steps):
        passed = f"`{score}` >= {i / steps}D"
        cells.append(F.expr(f"count_if({passed}) AS predicted{i}"))
        cells.append(F.expr(f"count_if({passed} AND `{label}` = 1) AS tp{i}"))
    points = ", ".join(
        f"struct({i / steps}D AS threshold, coalesce(try_divide(2D * tp{i}, predicted{i} + positives), 0D) AS f1)"
        for i in range(steps)
    )
    return rows.agg(*cells).selectExpr(f"inline(array({points}))")


def confusion(rows: DataFrame, prediction: str, label: str) -> DataFrame:
    """(label, prediction, count)."""
    return rows.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("count")
    )


def weighted_report(rows: DataFrame, prediction: str, label: str) -> DataFrame:
    """One row: precision, recall and F1 averaged over the classes by support."""
    cells = confusion(rows, prediction, label)
    actual = "struct(label AS class, count AS support, 0L AS predicted, IF(label = prediction, count, 0L) AS hits)"
    guessed = "struct(prediction AS class, 0L AS support, count AS predicted, 0L AS hits)"
    per_class = (
        cells.selectExpr(f"inline(array({actual}, {guessed}))")
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
        .selectExpr(
            "support",
            "coalesce(try_divide(hits, predicted), 0D) AS p",
            "coalesce(try_divide(hits, support), 0D) AS r",
            "coalesce(try_divide(2D * hits, predicted + support), 0D) AS f",
        )
    )
    return per_class.agg(
        *[F.expr(f"sum({c} * support) / sum(support)").alias(name) for c, name in
          (("p", "precision"), ("r", "recall"), ("f", "f1"))],
        F.sum("support").alias("support"),
    )


def binary_report(rows: DataFrame, prediction: str, label: str, by: str | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class, optionally per group (train, test)."""
    hit = f"`{prediction}` = 1 AND `{label}` = 1"
    counted = rows.groupBy(*([by] if by else [])).agg(
        F.expr(f"avg(CAST(`{prediction}` = `{label}` AS DOUBLE))").alias("accuracy"),
        F.expr(f"count_if({hit})").alias("tp"),
        F.expr(f"count_if(`{prediction}` = 1)").alias("predicted"),
        F.expr(f"count_if(`{label}` = 1)").alias("actual"),
    )
    return counted.selectExpr(
        *([by] if by else []),
        "accuracy",
        "coalesce(try_divide(tp, predicted), 0D) AS precision",
        "coalesce(try_divide(tp, actual), 0D) AS recall",
        "coalesce(try_divide(2D * tp, predicted + actual), 0D) AS f1",
    )


def training_report(rows: DataFrame, score: str, label: str, ranges: Ranges = Ranges()) -> DataFrame:
    """One row: cross-entropy, squared error, accuracy at 0.5, mean score, mean label, ROC AUC, average precision."""
    p = f"least(greatest(`{score}`, {PROBABILITY_FLOOR}D), {1 - PROBABILITY_FLOOR}D)"
    means = rows.agg(
        F.expr(f"avg(-(`{label}` * ln({p}) + (1 - `{label}`) * ln(1 - {p})))").alias("label_crossentropy"),
        F.expr(f"avg((`{score}` - `{label}`) * (`{score}` - `{label}`))").alias("mse"),
        F.expr(f"avg(CAST((`{score}` > 0.5D) = (`{label}` = 1) AS DOUBLE))").alias("accuracy"),
        F.avg(score).alias("prediction_mean"),
        F.avg(F.col(label).cast("double")).alias("label_mean"),
    )
    ranking = _by_score(rows, score, label, ranges).agg(
        F.struct(F.expr(ROC_AUC).alias("auc"), F.expr(AVERAGE_PRECISION).alias("ap"))
    ).scalar()
    return means.select(
        "*", ranking.getField("auc").alias("roc_auc"), ranking.getField("ap").alias("average_precision")
    )
