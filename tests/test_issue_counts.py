"""Issue counts of a table against a plain count over its rows, and one scan per table in the plan."""

import datetime as dt
import random
from collections import Counter

from policy_analytics.operators import quality
from policy_analytics.sources import fixtures as fx
from conftest import SMOKE

AS_OF = dt.date(2024, 12, 31)


def counted(rows):
    """(basic, business) issues of rows (contractid, mandantid, surrender_value)."""
    def missing(x):
        return x is None or x in ("", "NULL", "null") or x != x
    basic = sum(missing(x) for r in rows for x in r) + len(rows) - len(set(map(str, rows))) + len(rows) - len({r[0] for r in rows})
    ids = [r[0] for r in rows if r[0]]
    bad = sum(not (i[0] == "V" and i[1:].isdigit()) for i in ids)
    odd = {r[1] for r in rows} - {"LV1", "LV2", None}
    return basic, bad + (0 if ids else 1) + sum(r[2] is not None and r[2] < 0 for r in rows) + len(odd)


def test_counts_equal_a_plain_count(spark):
    rng = random.Random(8)
    schema = "contractid string, mandantid string, surrender_value double"
    for n in (0, 1, 500):
        rows = [(rng.choice([None, "", "NULL", "V1", "V2", "v3", "x"]), rng.choice([None, "LV1", "LV2", "LV9", "?"]),
                 rng.choice([None, float("nan"), -1.0, 0.0, 5.0])) for _ in range(n)]
        got = quality.table_issues(spark.createDataFrame(rows, schema).repartition(3), "t", AS_OF).first()
        assert (got["basic_issues"], got["business_issues"]) == counted(rows), n
        assert got["issues_found"] == sum(counted(rows))


def test_each_table_is_scanned_once(spark):
    for name in ("customers", "timeseries"):
        df = fx.CLEAN_VIEWS[name](spark, SMOKE)
        plan = quality.table_issues(df, name, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
        assert Counter("Relation [" in ln for ln in plan.splitlines())[True] == 1, plan
