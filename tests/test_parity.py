"""Every named query against its plain SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    con = connect(FOLDER)
    con.execute("set memory_limit='4GB'")
    return con


# The text operators, if they are there, have tests of their own.
@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query(spark, engine, name):
    df = entry.queries()[name](spark, FOLDER)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        problem = difference(df, engine, sql)
        assert problem is None, problem


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and [r.nome for r in rows] == sorted(r.nome for r in rows)
