"""Every checked query against its DuckDB statement; the others must yield rows."""

import pytest

from checks import catalog, compare


@pytest.fixture(scope="module")
def con(sf):
    return compare.duck(sf)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_same_rows_as_sql(spark, sf, con, name):
    assert compare.difference(catalog.QUERIES[name](spark, sf), con, catalog.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_yields_rows(spark, sf, name):
    assert not catalog.QUERIES[name](spark, sf).isEmpty()
