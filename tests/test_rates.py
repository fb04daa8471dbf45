"""Rate checks (R1-R16): thresholds at their boundaries, keyed and unkeyed."""

import datetime as dt

from policy_analytics.operators import rates

AS_OF = dt.date(2024, 12, 31)
D0 = dt.date(2024, 1, 1)


def series(spark, pairs, key=None):
    if key:
        return spark.createDataFrame([(key, d, v) for d, v in pairs], "k string, date date, interest_rate double")
    return spark.createDataFrame(pairs, "date date, interest_rate double")


def test_gap_boundary(spark):
    s = series(spark, [(D0, 1.0), (D0 + dt.timedelta(35), 1.0), (D0 + dt.timedelta(71), 1.0),
                       (D0 + dt.timedelta(71), 2.0)])
    r = rates.gaps(s).first()
    assert (r.dates, r.large_gaps, r.max_gap_days) == (3, 1, 36)


def test_outlier_rule(spark):
    ten = [(D0 + dt.timedelta(i), 0.0) for i in range(9)] + [(D0 + dt.timedelta(9), 100.0)]
    assert rates.outliers(series(spark, ten), "interest_rate").first().outliers is None   # n = 10: skipped
    vals = [1.0] * 20 + [50.0]
    s = series(spark, [(D0 + dt.timedelta(i), v) for i, v in enumerate(vals)])
    assert rates.outliers(s, "interest_rate").first().outliers == 1


def test_outlier_exactly_three_sd_is_not_outlier(spark):
    # values -a, +a repeated with mean 0; a point at exactly 3 sd is not counted (strict >)
    import numpy as np
    base = [-1.0, 1.0] * 10
    sd = float(np.std(base + [0.0], ddof=1))
    s = series(spark, [(D0 + dt.timedelta(i), v) for i, v in enumerate(base + [0.0])])
    assert rates.outliers(s, "interest_rate").first().outliers == 0
    assert sd > 0


def test_recency_classes(spark):
    for days, label in [(7, "fresh"), (8, "aged"), (30, "aged"), (31, "stale")]:
        s = series(spark, [(AS_OF - dt.timedelta(days), 1.0)])
        assert rates.recency(s, AS_OF).first().recency == label


def test_jump_boundary(spark):
    s = series(spark, [(D0, 0.0), (D0 + dt.timedelta(31), 2.0), (D0 + dt.timedelta(62), 4.01)])
    r = rates.jumps(s, "interest_rate").first()
    assert r.large_jumps == 1


def test_keyed_checks(spark):
    a = [(D0 + dt.timedelta(40 * i), float(i)) for i in range(5)]
    df = series(spark, a, key="A").unionByName(series(spark, a[:2], key="B"))
    g = {r.k: r.large_gaps for r in rates.gaps(df, key="k").collect()}
    assert g == {"A": 4, "B": 1}


def test_status_and_rollup(spark):
    days = [(D0 + dt.timedelta(i), 1.0 + i / 100) for i in range(90)]
    roll = rates.monthly_rollup(series(spark, days))
    rows = {r.year_month: r for r in roll.collect()}
    assert rows["2024-01"].data_points == 31 and rows["2024-01"].date == dt.date(2024, 1, 31)
    assert rows["2024-01"].interest_rate == 1.30
    q = rates.rate_quality(roll, AS_OF).first()
    assert q.status in ("excellent", "minor", "major") and q.missing_columns == 0
    assert rates.schema_diff(series(spark, days)) == [("year_month", "missing")]
