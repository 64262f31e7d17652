"""Every registered query against its reference SQL in DuckDB."""

import pytest
from compare import connect, differences
from conftest import SF

import __spark_entry__ as entry_module
from tidemark.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert differences(df, con, ORACLES[name]) == []
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() == 10


def test_every_query_has_reference_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(ORACLES) <= set(entry_module.oracle_sql())
