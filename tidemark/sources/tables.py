"""The tables of one scale-factor folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(scan: DataFrame) -> DataFrame:
    """A scan with fewer splits than cores, dealt out over the cores; any larger scan as it is.

    For CPU-heavy work per row on a table stored as a few small files.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the JSON property ``k`` as a column and a coarse ``segment`` of users."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        F.from_json("props", "k INT", {"mode": "FAILFAST"}).getField("k").alias("k"),
        F.pmod(F.col("user_id"), F.lit(50)).alias("segment"),
        "event_type",
        "value",
    )
