"""Every query with SQL against DuckDB, on the smallest tables."""
import pytest

import oracle
from stayflow.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    got = oracle.run_spark(QUERIES[name](spark, SF_DIR))
    assert oracle.compare(got, oracle.run_sql(con, ORACLES[name])).startswith("ok")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0
