"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as entry
import check

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return check.connect(sf)


def test_registered_names_agree():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, sf, name):
    verdict = check.compare(spark, con, sf, name, QUERIES[name], SQL.get(name))
    assert verdict.startswith(("ok", "rows-only")), verdict


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
