"""Registered text queries against their SQL (ORACLE_SF, 0.001 by default)."""

import importlib
import os

import pytest

import compare

FOLDER = f"/root/testdata/sf{os.environ.get('ORACLE_SF', '0.001')}"
contract = importlib.import_module("__spark_entry__")
QUERIES, SQL = contract.queries(), contract.oracle_sql()
NAMES = [n for n in contract.llm.QUERIES if n in SQL]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_queries_with_sql():
    assert {"op1_line_dedup", "op6_exact_dedup"} <= set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_text_query_equals_sql(spark, name):
    found = QUERIES[name](spark, FOLDER)
    assert compare.differences(found, compare.connect(FOLDER), SQL[name]) == []
