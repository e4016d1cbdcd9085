"""Tokenisers, name rules, label rules, word counts and job metrics on hand-made cases."""

from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.functions import sequences as Q
from tidemark.functions import text as T
from tidemark.functions import times
from tidemark.operators.wordcount import count_words, line_metrics, observe_lines


def apply(spark, text, fn):
    return spark.createDataFrame([(text,)], "value STRING").select(fn(F.col("value"))).first()[0]


@pytest.mark.parametrize(
    "text, fn, want",
    [
        ("it's Don'T o'clock", T.words, ["it's", "don", "t", "o'c", "lock"]),
        ("a b ", T.space_tokens, ["a", "b", ""]),
        ("a b ", lambda c: T.space_tokens(c, keep_trailing_empty=False), ["a", "b"]),
        ("", lambda c: T.space_tokens(c, keep_trailing_empty=False), [""]),
        ("   ", lambda c: T.space_tokens(c, keep_trailing_empty=False), []),
        (" a  b", lambda c: T.space_tokens(c, keep_trailing_empty=False), ["", "a", "", "b"]),
        ("  hi, You.", T.non_word_tokens, ["", "hi", "you", ""]),
        ("a\tB  c", T.whitespace_tokens, ["a", "B", "", "c"]),
        ("1,a b ", lambda c: T.csv_field(c, 1), "a b "),
    ],
)
def test_tokens(spark, text, fn, want):
    assert apply(spark, text, fn) == want


def test_a_line_without_the_field_raises(spark):
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        apply(spark, "no comma", lambda c: T.csv_field(c, 1))


@pytest.mark.parametrize(
    "name, merged",
    [
        ("sharecone-weighted-Hindi-interaction_2kth_3day-[1]", "sharecone-weighted-interaction_2kth_3day-[1]"),
        ("sharecone-weightedlag-Tamil-a-b", "sharecone-weightedlag-a-b"),
        ("sharecone-weighted-Hindi", "sharecone-weighted-"),
        ("sharecone-weighted-Hindi-latestMinView", "sharecone-weighted-latestMinView"),
        ("x-latestMinView-y", "latestMinView"),
        ("promoted", "promoted"),
    ],
)
def test_source_names(spark, name, merged):
    assert apply(spark, name, T.simplify_source) == merged


def test_latest_view_sources_may_stay(spark):
    assert apply(spark, "x-latestMinView-y", lambda c: T.simplify_source(c, merge_latest_view=False)) == "x-latestMinView-y"


@pytest.mark.parametrize("text, want", [*[(t, True) for t in T.TRUE_SPELLINGS], *[(t, False) for t in T.FALSE_SPELLINGS]])
def test_strict_bool(spark, text, want):
    assert apply(spark, text, T.strict_bool) is want


@pytest.mark.parametrize("text", ["yes", "", "tRUE", None])
def test_strict_bool_raises(spark, text):
    with pytest.raises(Exception, match="not a boolean"):
        apply(spark, text, T.strict_bool)


@pytest.mark.parametrize(
    "text, fn, want",
    [
        ("(3, 2)", T.vote_label, 1),
        ("(1, 4)", T.vote_label, 0),
        ("(2, 3)", T.vote_label, 2),
        ("4", T.grade_label, 1),
        ("2", T.grade_label, 0),
        ("3", T.grade_label, 2),
        ("true", T.truth_label, 1),
        ("false", T.truth_label, 0),
        ("----", T.truth_label, 2),
    ],
)
def test_labels(spark, text, fn, want):
    assert apply(spark, text, fn) == want


@pytest.mark.parametrize(
    "text, keep, want",
    [
        ("5 7", "oldest", ["5", "7", "0", "0"]),
        ("", "oldest", ["0", "0", "0", "0"]),
        ("1 2 3 4 5", "oldest", ["1", "2", "3", "4"]),
        ("1 2 3 4 5", "newest", ["2", "3", "4", "5"]),
        ("1  2", "oldest", ["1", "0", "2", "0"]),
    ],
)
def test_padding(spark, text, keep, want):
    assert apply(spark, text, lambda c: Q.padded_sequence(c, 4, keep)) == want


def test_times(spark):
    got = spark.range(1).select(
        times.micros(times.from_epoch_millis(F.lit(1683116230123))).alias("ms"),
        times.micros(times.from_epoch_seconds(F.lit(1680652800))).alias("s"),
        times.micros(times.parse_iso_seconds(F.lit("2023-03-10T13:15:50"))).alias("iso"),
    ).first()
    assert tuple(got) == (1683116230123000, 1680652800000000, 1678454150000000)


def test_counts_and_metrics(spark):
    lines = spark.createDataFrame([("Tea tea coffee",), ("  ",), ("extraordinary",)], "value STRING")
    counted = {r["word"]: r["count"] for r in count_words(lines, T.words(F.col("value"))).collect()}
    assert counted == {"tea": 2, "coffee": 1, "extraordinary": 1}
    want = {
        "empty_lines": 1,
        "small_words": 3,
        "lines": 3,
        "line_length_sum": 29,
        "line_length_min": 2,
        "line_length_max": 14,
    }
    assert line_metrics(lines).first().asDict() == want
    seen = Observation("job")
    count_words(observe_lines(lines, seen), T.words(F.col("value"))).collect()
    assert seen.get == want


def test_result_parts(spark):
    lines = spark.createDataFrame([("a b c d e f g h",)], "value STRING")
    assert count_words(lines, T.words(F.col("value")), partitions=3).rdd.getNumPartitions() == 3
