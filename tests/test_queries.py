"""Every registered query against its checking SQL on the given tables."""

import pytest
from oracle import compare, connect

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, db, name):
    said = compare(spark, db, SF_DIR, entry.queries()[name], entry.oracle_sql().get(name))
    assert said.startswith(("ok", "rows only")), said


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["item", "facts", "total", "gaps"]
    assert result.filter("gaps > 0").count() == 0
