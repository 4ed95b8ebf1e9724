"""Every registered query runs; those with checking SQL agree with it row for row."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from lumetra.schemas import LOG_DETAIL_COLUMNS
from tests.oracle import compare, connect

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees(name, spark, sf_dir, con):
    assert compare(con, ORACLES[name], QUERIES[name](spark, sf_dir)) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - {"als_grid_search", "als_test_rmse", "rec_job"}))
def test_other_query_gives_rows(name, spark, sf_dir):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = entry(spark)
    assert df.columns == LOG_DETAIL_COLUMNS
    assert df.count() > 0
