"""Every registered query on the smallest tables, against its SQL where it has one."""

import pytest
from oracle import compare, connect

from tallyrow import catalog

QUERIES, ORACLES = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf, con, name):
    if name in ORACLES:
        assert compare(spark, con, sf, QUERIES[name], ORACLES[name]) is None
    else:
        assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    issues = e.entry(spark)
    assert issues.columns == ["id", "kind", "column", "severity", "detail", "affected", "examples"]
    assert issues.count() == 13
