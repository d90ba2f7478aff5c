"""Registered queries of the subpackage against their SQL, and the pipeline's registration."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from rewardtables.llm import queries
from tests.oracle import connect, spark_rows, sql_rows

SMALL = "/root/testdata/sf0.001"


def test_registered():
    names = set(driver.queries())
    assert "pipeline" in names
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in queries.queries()} == set(range(1, 14))
    assert set(queries.queries()) <= names
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_matches_sql(spark, name):
    columns, rows = sql_rows(connect(SMALL), queries.oracle_sql()[name])
    got_columns, got = spark_rows(queries.queries()[name](spark, SMALL))
    assert got_columns == columns
    assert got == rows and rows
