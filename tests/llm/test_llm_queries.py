"""Registered queries against their SQL twins; those without one must give a row for each input row."""

from __future__ import annotations

import pytest
from oracle import SF_DIR, difference, oracle_connection

from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), oracle_connection(SF_DIR), ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_yields_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
