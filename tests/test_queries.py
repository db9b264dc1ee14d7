"""Every registered query against its SQL twin, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from tools.check import compare, oracle

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    return oracle(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, db, name):
    df = QUERIES[name](spark, sf)
    if name not in SQL:
        assert df.columns
        df.count()
        return
    verdict = compare(df, db, SQL[name])
    assert verdict.startswith("ok"), verdict
    assert "[" not in verdict, verdict  # types agree as well


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
