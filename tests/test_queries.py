"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import pytest

from compare import connect, differences
from modelyard.plans.catalog import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    entry = QUERIES[name]
    df = entry.run(spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if entry.sql is None:
        assert df.count() > 0
    else:
        assert differences(df, con, entry.sql) == []


def test_entry(spark):
    import __spark_entry__ as driver

    row = driver.entry(spark).first()
    assert row["n"] > 0 and row["deploy_flag"] in (0, 1)
    assert set(driver.oracle_sql()) <= set(driver.queries())
