"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract
from tools.check_oracles import compare, connect

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    frame = contract.queries()[name](spark, SF_DIR)
    assert compare(spark, duck, SF_DIR, name, frame) is None
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan  # no row-at-a-time Python


def test_every_oracle_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "sales_date", "channel", "order_count", "units_sold", "gross_revenue"]
