"""Every registered query against its SQL, at the smallest scale (``python -m oracle.compare sf0.01`` for the next)."""

import pytest

import __spark_entry__
from support import SMALL
from oracle.compare import compare, duck

SQL = __spark_entry__.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, con, name):
    assert compare(spark, con, SMALL, __spark_entry__.queries()[name], SQL[name]) is None


def test_entry(spark):
    got = __spark_entry__.entry(spark)
    assert got.count() > 0 and got.columns[0] == "icb_code"
