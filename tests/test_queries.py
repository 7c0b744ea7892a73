"""Every registered query next to its SQL on the smallest data."""

import pytest

import __spark_entry__ as entry
from conftest import SF
from oracle import compare, connect

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert rows
        return
    got = con.execute(SQL[name])
    assert compare(rows, df.columns, got.fetchall(), [d[0] for d in got.description]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(entry.queries())
