"""Every registered query against its SQL on an independent engine."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from tests.harness import connect, difference
from tidemark.plans.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, con, sf_dir, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    want = con.execute(ORACLE[name]).df()
    assert difference(got, want) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
