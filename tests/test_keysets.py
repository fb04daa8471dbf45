"""Key sets against Python sets, and the referential checks on tables with real gaps."""

import random

import pytest
from pyspark.sql import functions as F

from policy_analytics.operators import keysets as K
from policy_analytics.operators import quality

FORMS = ["V0", "V1", "V63", "V64", "V007", "v12", "12", "", " V5", "K9", "V999999999999999999", "V1234567890123456789", "Vé", None]


def keys(n, seed, top=500):
    rng = random.Random(seed)
    return [rng.choice(FORMS) if rng.random() < 0.2 else f"V{rng.randrange(top)}" for _ in range(n)] + ["V3"] * n


@pytest.fixture(scope="module")
def two(spark):
    a, b = keys(800, 1), keys(500, 2, 300)
    return a, b, *(spark.createDataFrame([(k,) for k in x], "k string").repartition(5) for x in (a, b))


def test_sets_equal_python_sets(two):
    a, b, da, db = two
    sa, sb = K.key_set(da, "k"), K.key_set(db, "k")
    one, other = set(a) - {None}, set(b) - {None}
    for s, want in ((sa, one), (K.minus(sa, sb), one - other), (K.minus(sb, sa), other - one)):
        rows = [r["k"] for r in K.members(s, "k").collect()]
        assert len(rows) == len(want) and set(rows) == want
        assert s.agg(*K.size("bits")).first()["bits"] == len(want)
    both = K.side_by_side(sa, x=sb).agg(*K.size("bits", "x")).first()
    assert (both["bits"], both["x"]) == (len(one), len(one & other))
    empty = K.key_set(da.where("false"), "k")
    assert K.members(empty, "k").isEmpty() and empty.agg(*K.size("bits")).first()["bits"] == 0


def test_having_keeps_rows(two):
    a, b, da, db = two
    s, there = K.key_set(db, "k"), set(b) - {None}
    assert sorted(map(str, (r["k"] for r in K.having(da, "k", s).collect()))) == sorted(k for k in a if k in there)
    out = [r["k"] for r in K.having(da, "k", s, inside=False).collect()]
    assert sorted(map(str, out)) == sorted(str(k) for k in a if k not in there)


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(4)
    contracts = [(k, None if rng.random() < 0.4 else f"K{rng.randrange(90)}") for k in keys(300, 5)]
    customers = [(f"K{i}",) for i in range(0, 140, 2)] + [(None,), ("K007",)]
    series = [(k,) for k in keys(400, 6, 650)]
    return (contracts, customers, series, spark.createDataFrame(contracts, "contractid string, customerid string"),
            spark.createDataFrame(customers, "customerid string"), spark.createDataFrame(series, "contractid string"))


def test_referential_checks_on_real_gaps(tables):
    contracts, customers, series, dc, dk, ds = tables
    ids = {c for c, _ in contracts if c is not None}
    known = {k for k, in customers if k is not None}
    linked = {c for c, k in contracts if c is not None and k in known}
    there = {c for c, in series if c is not None}
    cover = {r["relation"]: (r["contracts"], r["matched"], r["missing"], r["coverage_percent"]) for r in quality.key_coverage(dc, dk, ds).collect()}
    assert cover == {"contracts_to_customers": (len(ids), len(linked), len(ids - linked), round(100 * len(linked) / len(ids), 1)),
                     "contracts_to_timeseries": (len(ids), len(ids & there), len(ids - there), round(100 * len(ids & there) / len(ids), 1))}
    assert 0 < len(linked) < len(ids) and 0 < len(ids - there)
    lost = sorted(map(str, (tuple(r) for r in quality.missing_customers(dc, dk).collect())))
    assert lost == sorted(map(str, {(c, k) for c, k in contracts if c is not None and k not in known})) and any("None" in x for x in lost)
    assert {r[0] for r in quality.missing_series(dc, ds).collect()} == ids - there
    counts = {r["table_name"]: r["distinct_keys"] for r in quality.key_counts(dc, dk, ds).collect()}
    assert counts == {"contracts": len(ids), "customers": len(known), "timeseries": len(there)}
    orphans = {r["kind"]: (r["orphans"], r["examples"]) for r in quality.orphan_keys(dc, dk, ds).collect()}
    loose = known - {k for _, k in contracts}
    assert orphans == {"customers_without_contract": (len(loose), ", ".join(sorted(loose)[:3])),
                       "timeseries_without_contract": (len(there - ids), ", ".join(sorted(there - ids)[:3]))}
    by_contract = dk.where("customerid is not null").select(F.regexp_replace("customerid", "K", "V").alias("contractid"))
    direct = quality.key_coverage(dc, by_contract, ds).first()
    assert direct["matched"] == len(ids & {k.replace("K", "V") for k in known})
    assert [r["coverage_percent"] for r in quality.key_coverage(dc.where("false"), dk, ds).collect()] == [None, None]
