"""Properties: idempotent cleaning, row accounting, semi + anti = distinct keys."""

from policy_analytics.operators import clean, quality
from policy_analytics.sources import fixtures as fx
from conftest import SMOKE


def test_cleaning_idempotent_and_accounted(spark):
    for name in ("contracts", "customers", "timeseries"):
        raw = fx.RAW_VIEWS[name](spark, SMOKE)
        once = clean.clean_table(raw, name, fx.AS_OF)
        twice = clean.clean_table(once.data, name, fx.AS_OF)
        assert twice.data.exceptAll(once.data).count() == 0 and once.data.exceptAll(twice.data).count() == 0
        log = once.log.first()
        assert log.final_rows + log.dropped_rows == log.original_rows


def test_semi_plus_anti_is_distinct(spark):
    c, t = fx.contracts(spark, SMOKE), fx.timeseries(spark, SMOKE)
    missing = quality.missing_series(c, t).count()
    cov = {r.relation: r for r in quality.key_coverage(c, fx.customers(spark, SMOKE), t).collect()}
    r = cov["contracts_to_timeseries"]
    assert r.matched + missing == r.contracts == c.select("contractid").distinct().count()


def test_coverage_links_by_contractid_when_customers_carry_it(spark):
    c = spark.createDataFrame([("V1", "K1"), ("V2", "K2"), ("V3", "K3")], "contractid string, customerid string")
    u = spark.createDataFrame([("K9", "V1"), ("K8", "V2"), ("K7", "V9")], "customerid string, contractid string")
    t = spark.createDataFrame([("V1",), ("V8",)], "contractid string")
    cov = {r.relation: (r.matched, r.missing) for r in quality.key_coverage(c, u, t).collect()}
    assert cov == {"contracts_to_customers": (2, 1), "contracts_to_timeseries": (1, 2)}
    orphans = {r.kind: (r.orphans, r.examples) for r in quality.orphan_keys(c, u, t).collect()}
    assert orphans == {"customers_without_contract": (1, "V9"), "timeseries_without_contract": (1, "V8")}
