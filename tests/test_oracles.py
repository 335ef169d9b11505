"""Every registered query against its SQL in DuckDB, values and schemas."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ledgerlark.plans import ORACLES, QUERIES
from tools.compare import difference, tables

from conftest import SF_DIR


@pytest.fixture(scope="module")
def duck():
    return tables(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    assert difference(df, duck, oracle_sql()[name]) is None


def test_every_query_of_the_library_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_results_are_not_empty(duck):
    for name, sql in oracle_sql().items():
        assert duck.execute(f"SELECT count(*) FROM ({sql})").fetchone()[0] > 0, name
