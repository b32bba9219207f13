"""Every registered query against its SQL on the smallest data set."""

import pytest
from oracle import check, connect

import __spark_entry__
from gridlake.queries import ORACLE, QUERIES

DIRECTORY = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(DIRECTORY)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem, rows, _ = check(spark, con, DIRECTORY, name, QUERIES[name], ORACLE.get(name))
    assert problem is None
    assert rows > 0 or name in MAY_BE_EMPTY


# At the smallest scale no part is dear enough, and every id has a partner.
MAY_BE_EMPTY = {"missing_components", "new_cases", "large_units"}


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
