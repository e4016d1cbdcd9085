"""Registry of queries over the provided tables and of their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``oracle`` is SQL that yields the same rows from the same tables."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        @wraps(run)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            # the tables hold zone-less timestamps, read as UTC
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        QUERIES[name] = in_utc
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return register
