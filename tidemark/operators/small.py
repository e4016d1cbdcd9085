"""Joins against tables that are usually small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise

SMALL_ROWS = 100_000


def hint_if_small(df: DataFrame, name: str, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Write ``df`` once and count it: broadcast up to ``max_rows``, left to the join planner beyond."""
    written = materialise(df, name)
    return F.broadcast(written) if written.limit(max_rows + 1).count() <= max_rows else written
