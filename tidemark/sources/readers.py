"""Readers with fixed schemas. Malformed input raises unless a reader says otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import times

FAIL = {"mode": "FAILFAST"}

# Field lists of the input formats
COUNTER_EVENT_INTS = ("event_time", "duration_ms", "like_counter", "gift_cheers_value", "gift_quantity")
COUNTER_EVENT = (
    "hostId STRING, memberId STRING, livestreamId VARIANT, event_name STRING, event_time STRING, "
    "duration_ms STRING, like_counter STRING, gift_cheers_value STRING, gift_quantity STRING"
)
INTERACTION = (
    "livestreamId", "hostId", "memberId", "interactionDate", "totalTimespentMins",
    "livestreamExitTime", "label", "evaluationFlag",
)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a file, folder or glob; compressed files included."""
    return spark.read.text(path)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**FAIL).json(path)


def json_lines_with(spark: SparkSession, path: str, schema: str, key: str) -> DataFrame:
    """Only the rows that carry ``key`` with a value."""
    return json_lines(spark, path, schema).where(F.col(key).isNotNull())


def csv_table(spark: SparkSession, path: str, schema: str, header: bool = True, sep: str = ",") -> DataFrame:
    """One CSV object, a folder of them, or a glob; gzip included."""
    return spark.read.schema(schema).options(**FAIL).csv(path, header=header, sep=sep)


def tsv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Headless tab-separated files; ``schema`` names the columns."""
    return csv_table(spark, path, schema, header=False, sep="\t")


def parquet_table(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> DataFrame:
    rows = spark.read.parquet(path)
    return rows.select(*columns) if columns else rows


def warehouse(
    spark: SparkSession, name: str, columns: Sequence[str] = (), where: str | None = None, limit: int | None = None
) -> DataFrame:
    """A catalog table; the column list and the predicate reach its scan."""
    rows = spark.table(name)
    if where:
        rows = rows.where(where)
    if columns:
        rows = rows.select(*columns)
    return rows if limit is None else rows.limit(limit)


def counter_events(lines: DataFrame) -> DataFrame:
    """JSON lines of counter events: integers arrive as text, time as epoch milliseconds.

    Rows whose ``livestreamId`` is missing or no string are left out; a malformed number raises.
    """
    rows = lines.select(F.from_json("value", COUNTER_EVENT, FAIL).alias("e")).select("e.*")
    numbers = {c: F.col(c).cast("bigint") for c in COUNTER_EVENT_INTS}
    numbers["event_time"] = times.from_epoch_millis(numbers["event_time"])
    named = rows.where(F.schema_of_variant("livestreamId") == "STRING")
    return named.withColumn("livestreamId", F.col("livestreamId").cast("string")).withColumns(numbers)


def interactions_csv(lines: DataFrame) -> DataFrame:
    """Headless interaction lines of eight fields; commas beyond the seventh stay in the last field."""
    parts = F.split("value", ",", len(INTERACTION))
    rows = lines.select(*[F.element_at(parts, i + 1).alias(name) for i, name in enumerate(INTERACTION)])
    return rows.withColumns(
        {
            "livestreamExitTime": times.from_epoch_seconds(F.col("livestreamExitTime").cast("bigint")),
            "label": F.col("label").cast("int"),
        }
    )


def tagged_union(dataset: DataFrame, features: DataFrame) -> DataFrame:
    """Both inputs as one, told apart by ``input_type``."""
    return dataset.withColumn("input_type", F.lit("DATASET")).unionByName(
        features.withColumn("input_type", F.lit("FEATURES")), allowMissingColumns=True
    )


def random_lines(ids: DataFrame, column: str = "id", words: int = 100, seed: int = 42) -> DataFrame:
    """Per id an ``id,text`` line of words of 1 to 3 random letters, each followed by a space.

    Letters are hashes of the id and their place, so lines are made where the ids
    are and a rerun repeats them. ``spark.range(n)`` serves as ids for plain load data.
    """
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def letter(position: int) -> str:
        return f"substring('{letters}', 1 + CAST(pmod(xxhash64({seed}, `{column}`, w, {position}), 52) AS INT), 1)"

    length = f"1 + pmod(xxhash64({seed}, `{column}`, w, 9), 3)"
    word = f"concat(substring(concat({letter(0)}, {letter(1)}, {letter(2)}), 1, CAST({length} AS INT)), ' ')"
    text = f"array_join(transform(sequence(1, {words}), w -> {word}), '')"
    return ids.selectExpr(f"concat(`{column}`, ',', {text}) AS value")
