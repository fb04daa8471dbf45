"""Plan shape: no Python in the hot path, no cross / nested-loop joins, pruned scans, exchanges."""

import pytest

from conftest import SMOKE
from policy_analytics.plans import registry

registry.load_all()
SIDE_EFFECT = {"snapshot_counts", "snapshot_roundtrip", "snapshot_verify", "snapshot_lookup", "json_records",
               "json_array_records", "csv_roundtrip", "csv_accepted", "csv_intake_log", "json_shapes"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - SIDE_EFFECT))
def test_no_python_udf_and_no_cartesian(spark, name):
    p = plan(registry.QUERIES[name](spark, SMOKE))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_series_scan_is_pruned(spark):
    p = plan(registry.QUERIES["growth"](spark, SMOKE))
    assert "ReadSchema: struct<l_partkey:bigint,l_linenumber:int,l_quantity:double,l_shipdate:timestamp_ntz>" in p


def test_growth_shuffles(spark):
    """Contract-day aggregate (one exchange on contract and date), then the window (one on contract)."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = registry.QUERIES["volatility"](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    ex = [ln for ln in p.splitlines() if "Exchange hashpartitioning" in ln]
    assert len(ex) == 2, p
    assert "contractid" in ex[0] and "date" in ex[1] or "date" in ex[0]
