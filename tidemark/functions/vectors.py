"""Dense vectors as ARRAY<DOUBLE> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zeros(dim: int) -> Column:
    return F.array_repeat(F.lit(0.0), dim)


def parse_vector(text: Column, dim: int) -> Column:
    """A JSON list of numbers; null or empty text gives the zero vector, malformed text raises."""
    parsed = F.from_json(text, "ARRAY<DOUBLE>", {"mode": "FAILFAST"})
    return F.when(text.isNull() | (text == ""), zeros(dim)).otherwise(parsed)


def or_zeros(vector: Column, dim: int) -> Column:
    """The vector, or zeros where it is missing or has a missing element."""
    broken = vector.isNull() | F.exists(vector, lambda x: x.isNull() | F.isnan(x))
    return F.when(broken, zeros(dim)).otherwise(vector.cast("array<double>"))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def affinity(user: Column, item: Column, *biases: Column) -> Column:
    """sigmoid(dot + biases); every bias counts once."""
    total = dot(user, item)
    for bias in biases:
        total = total + bias
    return sigmoid(total)


def from_wide(prefix: str, dim: int) -> Column:
    """Columns ``prefix0 … prefix{dim-1}`` as one vector."""
    return F.array(*[F.col(f"{prefix}{i}").cast("double") for i in range(dim)])


def to_wide(vector: str, prefix: str, dim: int) -> list[Column]:
    """One vector as columns ``prefix0 … prefix{dim-1}``."""
    return [F.col(vector)[i].alias(f"{prefix}{i}") for i in range(dim)]
