"""The driver contract, and every registered query against its oracle."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare, duck_connection
from placeseek.catalog import QUERIES


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "paisCamel" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    con = duck_connection(SF_SMALL)
    r = compare(spark, SF_SMALL, name, entry.queries()[name], entry.oracle_sql()[name], con)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["values_match"], r
