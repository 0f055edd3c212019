import pytest

from scrivena.plans.oracles import ORACLES
from scrivena.plans.queries import QUERIES
from tests.oracle import connect, rows_of, rows_of_sql


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert rows_of(QUERIES[name](spark, sf_dir)) == rows_of_sql(con, ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 5
    assert set(e.oracle_sql()) <= set(e.queries())
