"""Every query of the catalogue against its SQL."""

import pytest
from compare import rows_of, rows_of_sql

from fillforge.plans import catalogue

QUERIES, SQL = catalogue.queries(), catalogue.oracle_sql()


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name):
    df = QUERIES[name](spark, sf)
    names, want = rows_of_sql(SQL[name], sf)
    assert sorted(df.columns) == names
    assert rows_of(df) == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
