"""Every registered query with oracle SQL must match it on the small tables."""

import pytest

from quartermaster.plans.registry import ORACLE_SQL, QUERIES
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_oracle(spark, sf_dir, con, name):
    ok, msg = compare(spark, QUERIES[name], ORACLE_SQL[name], sf_dir, con)
    assert ok, f"{name}: {msg}"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_without_oracle_runs(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert df.count() > 0
