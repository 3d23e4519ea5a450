import duckdb
import pytest

import __spark_entry__ as contract
from catalog import oracles
from catalog.queries import QUERIES
from check_oracles import compare, duck
from tests.conftest import SF


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracles.all_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, name) is None


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r.lang for r in rows} == {"de", "en", "es", "fr"}
