"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from oracle import compare, connect
from storelens.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_agrees_with_sql(spark, con, name):
    assert name in contract.oracle_sql()
    problem = compare(spark, con, name, SF_DIR)
    assert problem is None, problem


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["date", "store_id", "product_id", "total_sales", "stock_availability",
                          "product_turnover_rate"]
    assert df.count() > 0
