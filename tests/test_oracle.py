"""Every registered query against its DuckDB oracle (small scale)."""

import os

import pytest

import __spark_entry__ as entry
from fixtures.oracle import ORACLE
from fixtures.registry import QUERIES
from tools.oracle_compare import compare, duck

SF = os.environ.get("STRATA_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, con, key):
    res = compare(spark, SF, [key], con)[key]
    assert "error" not in res, res
    assert res["rows_spark"] == res["rows_oracle"], res
    assert res["cols_match"] and res["values_match"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["SALES_KEY", "YARD_ID", "YARD_KEY", "APPOINTMENT_DATA_KEY",
                          "COMMODITY_NAME", "PRICE", "SELL_PRICE", "INVOICE_TOTAL", "ADDED_BY",
                          "ADDED_ON", "MODIFIED_BY", "MODIFIED_ON"]
