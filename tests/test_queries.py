import pytest

import __spark_entry__ as entry
from checks import oracle
from checks import queries as registered
from checks.compare import differences, duck

SMALL = "/root/testdata/sf0.001"
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


def test_every_query_has_sql():
    assert set(ORACLE) == set(registered.QUERIES)


@pytest.mark.parametrize("name", registered.QUERIES)
def test_query_equals_sql(spark, connection, name):
    assert differences(registered.QUERIES[name](spark, SMALL), connection, ORACLE[name]) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 20 and sum(r.reviews for r in rows) == 200
