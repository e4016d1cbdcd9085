"""Readers and writers on hand-made files."""

from __future__ import annotations

import gzip
import json
import os
import re
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from tidemark.sources import readers, writers


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value STRING")


def event(**fields):
    base = {
        "hostId": "h", "memberId": "m", "livestreamId": "l", "event_name": "view_end", "event_time": "1683116230123",
        "duration_ms": "5", "like_counter": "0", "gift_cheers_value": "0", "gift_quantity": "0",
    }
    return json.dumps({**base, **fields})


def test_counter_events(spark):
    rows = readers.counter_events(lines(spark, event(), event(livestreamId=None)))
    got = rows.collect()
    assert len(got) == 1
    assert got[0]["duration_ms"] == 5
    assert rows.select(F.unix_millis("event_time")).first()[0] == 1683116230123


@pytest.mark.parametrize("other", [7, 7.5, True, ["l"], {"l": 1}])
def test_ids_that_are_no_strings_are_left_out(spark, other):
    rows = readers.counter_events(lines(spark, event(), event(livestreamId=other), event(livestreamId="7"), event(livestreamId="")))
    assert rows.schema["livestreamId"].dataType.simpleString() == "string"
    assert sorted(r.livestreamId for r in rows.collect()) == ["", "7", "l"]


@pytest.mark.parametrize("bad", [event(duration_ms="five"), "{not json"])
def test_malformed_counter_events_raise(spark, bad):
    with pytest.raises(Exception):
        readers.counter_events(lines(spark, bad)).collect()


def test_interaction_lines_keep_commas_in_the_last_field(spark):
    got = readers.interactions_csv(lines(spark, "l,h,m,2023-04-05,1.5,1680652800,1,a,b,c")).first()
    assert got["evaluationFlag"] == "a,b,c"
    assert got["label"] == 1


def test_history_line(spark):
    row = spark.createDataFrame([("a", [1, 2], [])], "x STRING, p ARRAY<INT>, n ARRAY<INT>")
    assert row.select(writers.history_line(["x"], ["p", "n"])).first()[0] == "a,1 2,"


def part_files(path, suffix=""):
    return [os.path.join(path, f) for f in sorted(os.listdir(path)) if f.startswith("part") and f.endswith(suffix)]


def test_gzip_text(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.text(lines(spark, "x"), F.col("value"), path, gzip=True)
    assert gzip.open(part_files(path, ".gz")[-1], "rt").read() == "x\n"
    assert [r["value"] for r in readers.text_lines(spark, path).collect()] == ["x"]


def test_scored_labels(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.scored_labels(spark.createDataFrame([(0.25,), (0.05,)], "s DOUBLE").coalesce(1), "s", path)
    text = "".join(open(f).read() for f in part_files(path))
    assert sorted(text.splitlines()) == ["false\t0.0500", "true\t0.2500"]


def test_fixed_digits(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.tsv_fixed(spark.createDataFrame([("a", 1 / 3, 2)], "n STRING, x DOUBLE, k INT").coalesce(1), path)
    assert open(part_files(path)[0]).read().splitlines() == ["n\tx\tk", "a\t0.333\t2"]


def test_key_value_lines(spark):
    row = spark.createDataFrame([("w", 3)], "word STRING, count INT")
    assert row.select(writers.key_value_line("word", "count")).first()[0] == "w\t3"
    assert row.select(writers.key_value_line("word")).first()[0] == "w"
    assert row.select(writers.word_line()).first()[0] == "w: 3"
    assert row.select(writers.tab_line(["count", "word"])).first()[0] == "3\tw"


def test_daily_append(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame(
        [(1, datetime(2023, 3, 10, 13, tzinfo=UTC)), (2, datetime(2023, 3, 11, tzinfo=UTC))], "id INT, at TIMESTAMP"
    )
    writers.append_daily(rows, "at", path)
    writers.append_daily(rows, "at", path)
    assert sorted(d for d in os.listdir(path) if d.startswith("date")) == ["date=2023-03-10", "date=2023-03-11"]
    assert spark.read.parquet(path).count() == 4


@pytest.fixture
def sinks(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sinks LOCATION '{tmp_path}'")
    yield tmp_path
    spark.sql("DROP DATABASE sinks CASCADE")


def test_replace_table(spark, sinks):
    writers.replace_table(spark.range(3), "sinks.result")
    writers.replace_table(spark.range(2), "sinks.result")
    assert readers.warehouse(spark, "sinks.result").count() == 2
    assert readers.warehouse(spark, "sinks.result", limit=1).count() == 1
    with pytest.raises(ValueError, match="columns"):
        writers.replace_table(spark.range(2).toDF("other"), "sinks.result")
    # a table may be made from its own rows
    writers.replace_table(spark.table("sinks.result").unionByName(spark.range(5)), "sinks.result")
    assert spark.table("sinks.result").count() == 7


def test_a_failed_replacement_leaves_the_table(spark, sinks):
    """The write dies half-way: some of its tasks have written, one fails."""
    writers.replace_table(spark.range(100), "sinks.result")
    broken = spark.range(0, 1000, 1, 8).selectExpr("IF(id = 999, CAST(raise_error('killed') AS BIGINT), id) AS id")
    with pytest.raises(Exception, match="killed"):
        writers.replace_table(broken, "sinks.result")
    assert spark.table("sinks.result").agg({"id": "sum"}).first()[0] == 4950
    writers.replace_table(spark.range(10), "sinks.result")
    assert spark.table("sinks.result").count() == 10


def test_readers_see_the_old_or_the_new_table(spark, sinks):
    writers.replace_table(spark.range(100), "sinks.result")
    before = spark.table("sinks.result")
    before.count()
    writers.replace_table(spark.range(10), "sinks.result")
    assert spark.table("sinks.result").count() == 10
    assert before.agg({"id": "max"}).first()[0] in (9, 99)
    for n in (20, 30, 40):
        writers.replace_table(spark.range(n), "sinks.result")
    assert len(list(sinks.glob("**/version-*"))) == 2


def test_report(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.report(spark.createDataFrame([(0.5,)], "auc DOUBLE").coalesce(1), path, config="c.yaml")
    assert json.loads(open(part_files(path)[0]).read()) == {"auc": 0.5, "config": "c.yaml"}


def test_json_rows_with_key(spark, tmp_path):
    path = str(tmp_path / "in")
    writers.text(lines(spark, '{"prompt": "a", "HR": 1}', '{"prompt": "b"}'), F.col("value"), path)
    got = readers.json_lines_with(spark, path, "prompt STRING, HR INT", "HR").collect()
    assert [r["prompt"] for r in got] == ["a"]


def test_random_lines(spark):
    rows = readers.random_lines(spark.range(50), words=100)
    got = [r["value"] for r in rows.collect()]
    assert all(re.fullmatch(r"\d+,([a-zA-Z]{1,3} ){100}", line) for line in got)
    words = [w for line in got for w in line.split(",")[1].split()]
    assert {len(w) for w in words} == {1, 2, 3}
    assert len({c for w in words for c in w}) == 52
    assert got == [r["value"] for r in readers.random_lines(spark.range(50).repartition(3)).orderBy(
        F.split("value", ",")[0].cast("int")).collect()]


def test_tagged_union(spark):
    both = readers.tagged_union(spark.range(2), spark.range(3).withColumn("x", F.lit(1)))
    assert {(r["input_type"], r["x"]) for r in both.collect()} == {("DATASET", None), ("FEATURES", 1)}
