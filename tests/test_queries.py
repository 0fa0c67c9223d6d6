"""Registered queries against their SQL counterparts, at the smallest scale."""

import os

import pytest

import __spark_entry__ as contract
from levygrid.plans import catalog, oracles
from tests.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

# The composite ones and the cheap ones; LEVYGRID_ALL_QUERIES=1 runs every query.
DEFAULT = [
    "sheet_scan", "sheet_scan_line_breaks", "sheet_account", "header_mapping", "dim_state_names", "format_percent", "output_folder_name", "resolve_geocodes",
    "errors_report", "run_summary", "product_items", "matrix_update", "product_item_update", "matrix_order",
]
NAMES = sorted(catalog.queries()) if os.environ.get("LEVYGRID_ALL_QUERIES") else DEFAULT


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


def test_every_query_has_a_counterpart():
    assert catalog.queries().keys() == oracles.oracle_sql().keys()
    assert contract.queries().keys() >= catalog.queries().keys()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sql, name):
    df = contract.queries()[name](spark, FOLDER)
    assert difference(df, sql, contract.oracle_sql()[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 9393
