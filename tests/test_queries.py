"""Every registered query against its SQL equivalent, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from rewardtables.plans import catalog, oracles
from tests.oracle import connect, spark_rows, sql_rows

QUERIES = catalog.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES) <= set(driver.queries())
    assert set(ORACLES) <= set(driver.oracle_sql())
    # a tokenizer's merges are no SQL: see test_prompts
    assert set(QUERIES) - set(ORACLES) == {"word_tokenizer_tail"}


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert len(rows) == 8


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, sf_dir, name):
    columns, rows = sql_rows(con, ORACLES[name])
    got_columns, got = spark_rows(QUERIES[name](spark, sf_dir))
    assert got_columns == columns
    assert len(got) == len(rows) > 0
    assert got == rows
