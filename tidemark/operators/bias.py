"""A logistic model with one weight per id of each field, such as a user's and a creator's, fitted by grouped aggregation.

The log-odds of a row are the sum of its ids' weights. With the other fields' weights held, the weights of one field are
independent of each other: each takes a Newton step from its own gradient and curvature, which one aggregation by id
gives for all ids of the field. So no id table is collected or hashed, and ids are as many as there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise


@dataclass(frozen=True)
class Biases:
    """The weights (id, weight) of each field, and the objective before each pass over the fields."""

    fields: tuple[str, ...]
    weights: tuple[DataFrame, ...]
    objective: tuple[float, ...]

    def score(self, rows: DataFrame, name: str = "score", threshold: float = 0.5) -> DataFrame:
        """``rows`` plus the positive-class probability and the prediction at ``threshold``; unknown ids weigh nothing."""
        kept = [c for c in rows.columns if c != name]
        for i, (field, weights) in enumerate(zip(self.fields, self.weights)):
            side = weights.select(F.col("id").alias(f"_id{i}"), F.col("weight").alias(f"_w{i}"))
            rows = rows.join(side, F.col(field) == F.col(f"_id{i}"), "left")
        odds = " + ".join(f"coalesce(_w{i}, 0D)" for i in range(len(self.fields)))
        scored = rows.withColumn(name, F.expr(f"1 / (1 + exp(-({odds})))"))
        return scored.select(*kept, name, (F.col(name) >= threshold).cast("int").alias("prediction"))


def fit_biases(
    rows: DataFrame, fields: Sequence[str], label: str, ridge: float = 1.0, passes: int = 100, tolerance: float = 1e-7
) -> Biases:
    """Weights that minimise the logistic loss plus ``ridge`` / 2 times their squares, to a relative ``tolerance`` a pass.

    Rows of equal ids are counted once, before the passes. A null id weighs nothing; rows without a label teach nothing. No
    step raises the objective: a logistic loss's third derivative is at most its second, so a Newton step d of one weight
    is cut to ln(1 + |d|).
    """
    count = len(fields)
    named = rows.where(F.col(label).isNotNull()).select(*[F.col(f).alias(f"f{i}") for i, f in enumerate(fields)], F.col(label).alias("y"))
    ids = [f"f{i}" for i in range(count)]
    cells = materialise(named.groupBy(*ids).agg(F.count("*").alias("n"), F.sum(F.col("y").cast("double")).alias("positives")), "cells")
    whole = cells.where(" OR ".join(f"{i} IS NULL" for i in ids)).isEmpty()
    weights = [materialise(cells.select(F.col(i).alias("id")).where("id IS NOT NULL").distinct().selectExpr("id", "0D AS weight"), "weights") for i in ids]
    stats = [(w.count(), 0.0, 0.0) for w in weights]  # ids, sum, sum of squares
    shifts, history = [0.0] * count, []

    def step(field: int) -> float:
        """New weights of one field; returns the loss that the old ones have."""
        joined = cells
        for i, w in enumerate(weights):
            side = w.select(F.col("id").alias(f"f{i}"), (F.col("weight") + F.lit(shifts[i])).alias(f"w{i}"))
            joined = joined.join(side, f"f{i}", "left")
        z = " + ".join(f"coalesce(w{i}, 0D)" for i in range(count))
        own = (
            joined.selectExpr(f"f{field} AS id", f"w{field} AS weight", "n", "positives", f"{z} AS z")
            .selectExpr("*", "1 / (1 + exp(-z)) AS p", "n * (greatest(z, 0D) + log1p(exp(-abs(z)))) - positives * z AS loss")
            .groupBy("id")
            .agg(
                F.max("weight").alias("weight"),
                F.expr("sum(n * p - positives) AS slope"),
                F.expr("sum(n * p * (1 - p)) AS curve"),
                F.sum("loss").alias("loss"),
            )
        )
        newton = f"(slope + {ridge}D * weight) / (curve + {ridge}D)"
        moved = own.selectExpr("id", f"weight - signum({newton}) * log1p(abs({newton})) AS weight", "loss")
        written = materialise(moved, "weights")
        seen = written.agg(
            F.sum("loss").alias("loss"), F.expr("sum(weight)").alias("total"), F.expr("sum(weight * weight)").alias("squares")
        ).first()
        weights[field] = written.where("id IS NOT NULL").select("id", "weight")
        stats[field], shifts[field] = (stats[field][0], seen["total"] or 0.0, seen["squares"] or 0.0), 0.0
        return seen["loss"] or 0.0

    for _ in range(passes):
        before = sum(q + 2 * s * t + n * s * s for (n, t, q), s in zip(stats, shifts))
        for field in range(count):
            loss = step(field)
            if not field:
                history.append(loss + ridge / 2 * before)
        if whole and all(n for n, _, _ in stats):
            # shifts that add up to nothing change no row; those that minimise the squares spare many passes
            level = sum(t / n for n, t, _ in stats) / sum(1 / n for n, _, _ in stats)
            shifts = [level / n - t / n for n, t, _ in stats]
        if len(history) > 1 and history[-2] - history[-1] <= tolerance * max(1.0, abs(history[-1])):
            break
    final = tuple(w.select("id", (F.col("weight") + F.lit(s)).alias("weight")) for w, s in zip(weights, shifts))
    return Biases(tuple(fields), final, tuple(history))
