"""Every registered query against its SQL twin; those without one must at least yield rows."""

from __future__ import annotations

import pytest
from oracle import SF_DIR, difference, oracle_connection

from tidemark.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_yields_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
