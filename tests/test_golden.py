"""Golden-by-arithmetic checks on a constructed monthly rate series and defect-decision rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from policy_analytics.functions.stats import bin_left_closed
from policy_analytics.operators import quality, rates, series
from policy_analytics.sources import fixtures as fx

AS_OF = dt.date(2024, 12, 31)


def monthly_series(spark):
    """60 months 2020-01 .. 2024-12 on the 1st: 25 zero rates, then a rise in 0.25 steps,
    capped at 4.25, with one 0.5 step (the largest jump)."""
    rows, r = [], 0.0
    for i in range(60):
        d = dt.date(2020 + i // 12, i % 12 + 1, 1)
        if i >= 25:
            r = min(4.25, r + (0.5 if i == 30 else 0.25))
        rows.append((d, r, d.strftime("%Y-%m")))
    return spark.createDataFrame(rows, "date date, interest_rate double, year_month string")


def test_constructed_rate_series(spark):
    s = monthly_series(spark)
    assert s.where(F.col("interest_rate") == 0).count() == 25
    summary = rates.series_summary(s).first()
    assert (summary.points, summary.max_rate, summary.min_rate) == (60, 4.25, 0.0)
    assert rates.gaps(s).first().large_gaps == 0                         # month starts: <= 31 days
    j = rates.jumps(s, "interest_rate").first()
    assert j.large_jumps == 0 and j.max_change == pytest.approx(0.5)
    assert rates.bounds(s).first().out_of_bounds == 0
    assert rates.negatives(s).first().negatives == 0
    assert rates.recency(s, AS_OF).first().recency == "aged"              # 30 days old
    q = rates.rate_quality(s, AS_OF).first()
    assert (q.issues, q.status) == (0, "excellent")
    out = rates.outliers(s, "interest_rate").first()
    assert out.n == 60 and out.outliers == 0


def test_true_monthly_mean(spark):
    """The monthly mean is the mean of the daily rates, not the last rate."""
    days = [(dt.date(2024, 1, d), float(d)) for d in (1, 2, 3)]
    r = rates.monthly_rollup(spark.createDataFrame(days, "date date, interest_rate double")).first()
    assert (r.interest_rate, r.avg_rate, r.data_points) == (3.0, 2.0, 3)


def test_all_missing_ids_count_as_one_issue(spark):
    """With every id missing, invalid is 0 and the all-missing issue is 1."""
    df = spark.createDataFrame([(None,), ("",)], "contractid string")
    p = quality.id_format_profile(df, "contracts", "contractid").first()
    assert (p.invalid, p.all_missing_issue, p.missing) == (0, 1, 2)


def test_class_cut_on_rounded_volatility(spark):
    """With 3-digit rounding an sd of 0.9996 counts as 1.000 -> "Mittel"."""
    df = spark.createDataFrame([(0.9996,), (0.9994,)], "volatility double")
    got = [r[0] for r in df.select(bin_left_closed(F.round("volatility", 3), series.VOLATILITY_BREAKS,
                                                   series.CLASS_LABELS)).collect()]
    assert got == ["Mittel", "Niedrig"]


def test_fixture_views_have_expected_shapes(spark):
    smoke = "/root/testdata/sf0.001"
    assert fx.contracts(spark, smoke).columns == ["contractid", "customerid", "mandantid"]
    assert fx.timeseries(spark, smoke).columns == ["contractid", "date", "surrender_value"]
    assert fx.raw_customers(spark, smoke).columns == ["customer_id", "dob"]
