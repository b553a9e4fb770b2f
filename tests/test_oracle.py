"""Every registered query with a SQL twin gives exactly the twin's rows."""

import pytest

import __spark_entry__ as entry
from readings import SF
from oracle import compare, connect

QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_twin_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, con):
    ok, detail, _, rows = compare(QUERIES[name], ORACLE.get(name), spark, con, SF)
    assert ok, detail
    if name not in ORACLE:
        assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).columns[:3] == ["transformer_id", "substation_id", "region"]
