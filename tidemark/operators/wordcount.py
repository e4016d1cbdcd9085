"""Word counts: one plan, a tokeniser per flavour. Partial aggregation absorbs hot words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.text import words

SMALL_WORD = 9  # fixed value: words shorter than this count as small
BLANK_LINE = r"^[\s\x{0B}\x{85}\p{Z}]*$"


def count_words(lines: DataFrame, tokens: Column, partitions: int | None = None) -> DataFrame:
    """(word, count) over the array column ``tokens``; ``partitions`` sets how many parts the result has."""
    counted = lines.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return counted if partitions is None else counted.repartition(partitions, "word")


def _line_metrics(line: str, small: int) -> list[Column]:
    found = words(F.col(line))
    length = F.octet_length(line).cast("bigint")
    return [
        F.count_if(F.col(line).rlike(BLANK_LINE)).alias("empty_lines"),
        F.sum(F.size(F.filter(found, lambda w: F.length(w) < small))).alias("small_words"),
        F.count(line).alias("lines"),
        F.sum(length).alias("line_length_sum"),
        F.min(length).alias("line_length_min"),
        F.max(length).alias("line_length_max"),
    ]


def line_metrics(lines: DataFrame, line: str = "value", small: int = SMALL_WORD) -> DataFrame:
    """One row: blank lines, small words, and the distribution of line lengths in bytes."""
    return lines.agg(*_line_metrics(line, small))


def observe_lines(lines: DataFrame, observation: Observation, line: str = "value", small: int = SMALL_WORD) -> DataFrame:
    """``lines`` unchanged; the same metrics reach ``observation`` while another action runs."""
    return lines.observe(observation, *_line_metrics(line, small))
