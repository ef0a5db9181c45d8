"""Every registered query against its SQL, at one scale (ORACLE_SF, 0.001 by default)."""

import importlib
import os

import pytest

import compare
from salesmart import registry

FOLDER = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"
contract = importlib.import_module("__spark_entry__")
QUERIES, SQL = contract.queries(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(registry.QUERIES) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare.differences(QUERIES[name](spark, FOLDER), duck, SQL[name]) == []


def test_comparison_sees_a_changed_value(spark, duck):
    changed = QUERIES["monthly_sums"](spark, FOLDER).selectExpr(
        "year", "month", "total_revenue + 0.01 AS total_revenue", "total_profit",
        "avg_order_value", "total_quantity_sold",
    )
    assert compare.differences(changed, duck, SQL["monthly_sums"])


def test_entry(spark):
    assert contract.entry(spark).count() > 12
