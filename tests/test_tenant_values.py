"""M4 from counts below the join, against row-by-row numpy; M6 composes what its inputs allow."""

import datetime as dt

import numpy as np
import pytest

from conftest import SMOKE
from policy_analytics.operators import tenant
from policy_analytics.sources import fixtures as fx


def _brute(series, contracts):
    out = {}
    for m in {m for _, m in contracts if m is not None}:
        listed = [c for c, t in contracts if t == m and c is not None]
        vals = [(c, v) for c in listed for k, v in series if k == c and v is not None]
        if vals:
            out[m] = (np.array([v for _, v in vals]), len({c for c, _ in vals}))
    return out


def test_values_equal_row_by_row(spark):
    rng = np.random.default_rng(4)
    series = [("hot", float(v)) for v in rng.integers(0, 900, 6000)]
    series += [(f"V{i % 40}", float(v)) for i, v in enumerate(rng.normal(1e6, 3.0, 3000))]
    series += [("one", 7.25), ("V1", None), (None, 5.0), ("unlisted", 1.0)]
    contracts = [("hot", "LV1"), ("one", "LV3"), ("empty", "LV2"), (None, "LV1"), ("V39", None)]
    contracts += [(f"V{i}", "LV2" if i % 3 else "LV1") for i in range(39)]
    contracts += [("V4", "LV2"), ("V5", "LV1")]           # listed twice in one tenant, and in two tenants
    got = {r.mandantid: r for r in tenant.tenant_values(
        spark.createDataFrame(series, "contractid string, surrender_value double").repartition(6),
        spark.createDataFrame(contracts, "contractid string, mandantid string"), digits=None).collect()}
    want = _brute(series, contracts)
    assert set(got) == set(want)
    for m, (vals, n) in want.items():
        r = got[m]
        assert (r.observations, r.contracts) == (len(vals), n)
        assert r.mean_surrender_value == pytest.approx(vals.mean(), rel=1e-12)
        assert (r.min_surrender_value, r.max_surrender_value) == (vals.min(), vals.max())
        for q, x in (("q25", 0.25), ("median", 0.5), ("q75", 0.75)):
            assert r[f"{q}_surrender_value"] == pytest.approx(np.quantile(vals, x), rel=1e-12)
        if len(vals) > 1:
            assert r.std_surrender_value == pytest.approx(vals.std(ddof=1), rel=1e-9)
        else:
            assert r.std_surrender_value is None


def test_small_spread_around_a_large_mean(spark):
    vals = [1e9 + x for x in (0.0, 0.25, 0.5, 0.75)]
    r = tenant.tenant_values(spark.createDataFrame([("V1", v) for v in vals], "contractid string, surrender_value double"),
                             spark.createDataFrame([("V1", "LV1")], "contractid string, mandantid string"), digits=None).first()
    assert r.std_surrender_value == pytest.approx(np.std(vals, ddof=1), rel=1e-9)


def test_nan_infinite_and_empty(spark):
    contracts = spark.createDataFrame([("a", "LV1"), ("b", "LV2"), ("c", "LV3")], "contractid string, mandantid string")
    rows = [("a", float("nan")), ("b", float("inf")), ("b", 1.0), ("c", 2.0), ("c", 4.0)]
    got = {r.mandantid: r for r in tenant.tenant_values(
        spark.createDataFrame(rows, "contractid string, surrender_value double"), contracts).collect()}
    assert got["LV1"].observations == 1 and got["LV1"].median_surrender_value is None
    assert got["LV2"].max_surrender_value == float("inf")
    assert (got["LV3"].median_surrender_value, got["LV3"].std_surrender_value) == (3.0, 1.41)
    none = spark.createDataFrame([], "contractid string, surrender_value double")
    assert tenant.tenant_values(none, contracts).count() == 0


def _final_lines(df):
    """Lines of the executed plan without the initial plans, subqueries included."""
    out, skip = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        if skip is not None and depth >= skip:
            continue
        skip = depth if "== Initial Plan ==" in line else None
        if skip is None:
            out.append(line)
    return out


def test_series_is_read_and_joined_once(spark):
    df = tenant.tenant_values(fx.timeseries(spark, SMOKE), fx.contracts(spark, SMOKE))
    df.collect()
    lines = _final_lines(df)
    assert any("ReusedExchange" in x for x in lines)
    # stages used by several consumers are printed under each of them, with the same ids
    scans = {x.split("FileScan")[1] for x in lines if "FileScan parquet [l_partkey" in x}
    joins = {x.split("Join")[1] for x in lines if "Join [contractid#" in x}
    assert len(scans) == 1 and len(joins) == 1, "\n".join(lines)


def test_composition_by_inputs(spark):
    contracts = fx.contracts(spark, SMOKE)
    from policy_analytics.operators.age import classify_age_groups
    people = classify_age_groups(fx.customers(spark, SMOKE), dt.date(2024, 12, 31))
    assert set(tenant.create_mandant_summaries(contracts)) == {"distribution"}
    assert set(tenant.create_mandant_summaries(contracts, people.drop("age_group"))) == {"distribution", "age_analysis"}
    full = tenant.create_mandant_summaries(
        contracts, people, fx.timeseries(spark, SMOKE),
        spark.createDataFrame([("V1", 0.1, 1.0)], "contractid string, volatility double, risk_adjusted_return double"))
    assert set(full) == {"distribution", "age_analysis", "age_group_distribution", "surrender_value_analysis", "volatility_analysis"}
    assert tenant.create_mandant_summaries(contracts, None, contracts).keys() == {"distribution"}
