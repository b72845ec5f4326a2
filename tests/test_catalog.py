import pytest

import __spark_entry__ as contract
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_equals_its_sql(spark, con, name):
    df = contract.queries()[name](spark, FOLDER)
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) is None
    spark.catalog.clearCache()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
    spark.catalog.clearCache()
