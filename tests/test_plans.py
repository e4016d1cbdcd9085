"""The plans the operators are meant to get."""

from __future__ import annotations

import re

import pytest
from oracle import SF_DIR

from tidemark.plans import QUERIES

TRAINED = ("gbt", "als", "bias_lr", "text_lr")


def plan(spark, name: str) -> str:
    text = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().toString()
    return text[text.index("== Physical Plan ==") :]


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(TRAINED)))
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(spark, name)
    for node in ("NestedLoop", "CartesianProduct", "EvalPython", "FlatMapGroups", "MapInPandas", "MapInArrow"):
        assert node not in text


@pytest.mark.parametrize("name", ["decayed_counters_user", "decayed_counters_all"])
def test_one_wide_shuffle_serves_all_key_sets_gaps_and_counters(spark, name):
    df = QUERIES[name](spark, SF_DIR)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text[text.index("Final Plan") : text.index("Initial Plan")]
    keyed = [line for line in final.splitlines() if re.search(r"Exchange hashpartitioning\(_set", line)]
    assert len(keyed) == 1
    assert len(re.findall(r"\bWindow \[", final)) == 1


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "decayed_counters_user")
    assert "PushedFilters: [In(event_type, [click,error,signup,view])]" in text
    scan = plan(spark, "warehouse_scan")
    assert "EqualTo(o_orderstatus,F)" in scan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double>" in scan


def test_history_windows_share_one_shuffle(spark):
    df = QUERIES["user_history"](spark, SF_DIR)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text[text.index("Final Plan") : text.index("Initial Plan")]
    assert len([line for line in final.splitlines() if "Exchange hashpartitioning(_member" in line]) == 1
