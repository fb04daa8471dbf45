"""Distributed exact quantiles against numpy (linear interpolation), with a hot group."""

import numpy as np
import pytest

from policy_analytics.functions.stats import exact_quantiles


@pytest.mark.parametrize("parts", [1, 7, 32])
def test_exact_quantiles_match_numpy(spark, parts):
    rng = np.random.default_rng(parts)
    rows = [("hot", float(v)) for v in rng.integers(0, 500, 20000)]          # many repeats
    rows += [("cold", float(v)) for v in rng.normal(0, 1, 17)]
    rows += [("one", 3.5), ("nan", float("nan")), ("null", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
    probs = [0.5, 0.25, 0.75, 0.0, 1.0]
    got = {r.g: r for r in exact_quantiles(df, ["g"], "v", probs, ["q50", "q25", "q75", "q0", "q100"],
                                           slices=parts * 5).collect()}
    assert set(got) == {"hot", "cold", "one"}
    for g in ("hot", "cold", "one"):
        vals = np.array([v for k, v in rows if k == g])
        for name, p in zip(["q50", "q25", "q75", "q0", "q100"], probs):
            assert got[g][name] == pytest.approx(np.quantile(vals, p), rel=1e-12, abs=1e-12)


def test_global_quantile(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 11)], "v double")
    r = exact_quantiles(df, [], "v", [0.5], ["m"]).first()
    assert r.m == 5.5


def test_approx_switch_is_close(spark):
    from policy_analytics.functions.stats import quantiles
    rng = np.random.default_rng(5)
    vals = rng.normal(100, 10, 5000)
    df = spark.createDataFrame([("g", float(v)) for v in vals], "g string, v double")
    r = quantiles(df, ["g"], "v", [0.5], ["m"], accuracy=10000).first()
    assert abs(r.m - np.quantile(vals, 0.5)) < 0.5


def test_exact_rank_with_infinity(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),), (float("inf"),)], "v double")
    r = exact_quantiles(df, [], "v", [0.5, 1.0], ["m", "top"]).first()
    assert r.m == float("inf") and r.top == float("inf")


def test_reuse_of_exchanges_does_not_matter(spark):
    rng = np.random.default_rng(11)
    rows = [(None if i % 3 else "a", float(v)) for i, v in enumerate(rng.normal(0, 1, 6000))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    want = {g: np.quantile([v for k, v in rows if k == g], [0.5, 0.9]).tolist() for g in (None, "a")}
    for reuse in ("true", "false"):
        for adaptive in ("true", "false"):
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            try:
                got = exact_quantiles(df, ["g"], "v", [0.5, 0.9], ["m", "p"]).collect()
            finally:
                spark.conf.set("spark.sql.exchange.reuse", "true")
                spark.conf.set("spark.sql.adaptive.enabled", "true")
            assert len(got) == 2 and all([r.m, r.p] == pytest.approx(want[r.g]) for r in got)


def test_building_the_plan_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    df = spark.range(1000).selectExpr("id % 3 as g", "cast(id as double) as v")
    spark.sparkContext.setJobGroup("plan-only", "quantiles")
    try:
        exact_quantiles(df, ["g"], "v", [0.5], ["m"])._jdf.queryExecution().executedPlan()
        assert len(tracker.getJobIdsForGroup("plan-only")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_values_are_shuffled_twice_and_by_value(spark):
    df = spark.range(20000).selectExpr("if(id % 10 < 9, 'hot', cast(id as string)) as g", "cast(id as double) as v")
    out = exact_quantiles(df, ["g"], "v", [0.5], ["m"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan[:plan.index("== Initial Plan ==")]
    keyed = {ln[ln.index("Exchange hashpartitioning(_k"):] for ln in final.splitlines()
             if "Exchange hashpartitioning(_k" in ln and "Reused" not in ln}
    by_value = {ln for ln in keyed if "_v#" in ln or "_s#" in ln}
    assert 1 <= len(by_value) <= 3 and "rangepartitioning" not in final, final      # counted, ranked, one row per slice
