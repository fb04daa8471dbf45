"""Series analytics (T1-T19) against hand rows and a row-level brute force in pandas."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest

from policy_analytics.functions.stats import bin_left_closed
from policy_analytics.operators import series

D0 = dt.date(2020, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "contractid string, date date, surrender_value double")


def day(n):
    return D0 + dt.timedelta(days=n)


def test_growth_hand_rows(spark):
    rows = [("A", day(0), 100.0), ("A", day(30), 110.0), ("A", day(90), 110.0 * 1.1),
            ("B", day(0), 0.0), ("B", day(30), 10.0), ("B", day(60), 20.0),
            ("C", day(0), 100.0), ("C", day(0), 105.0), ("C", day(30), 110.0),
            ("D", day(0), 100.0), ("D", day(30), 110.0)]
    g = {(r.contractid, r.date): r for r in series.calculate_monthly_growth(frame(spark, rows)).collect()}
    assert g[("A", day(30))].monthly_growth_rate == pytest.approx(10.0)
    assert g[("A", day(90))].monthly_growth_rate == pytest.approx((1.1 ** 0.5 - 1) * 100)  # 60 days: 4.8809 %
    assert round(g[("A", day(90))].monthly_growth_rate, 4) == 4.8809
    assert ("B", day(30)) not in g and ("B", day(60)) in g        # previous value 0 -> dropped
    assert ("C", day(0)) not in g                                 # same day -> dropped (X8)
    assert g[("C", day(30))].previous_value == 105.0              # last value of the previous day
    assert not any(k[0] == "D" for k in g)                        # 2 rows < 3 observations


def brute_growth(pdf, min_obs=3, month_days=30.0):
    out = []
    pdf = pdf.dropna()
    for cid, g in pdf.groupby("contractid"):
        if len(g) < min_obs:
            continue
        g = g.sort_values(["date", "surrender_value"], kind="mergesort").reset_index(drop=True)
        for i in range(1, len(g)):
            p, c = g.iloc[i - 1], g.iloc[i]
            days = (c.date - p.date).days
            if p.surrender_value > 0 and days > 0:
                r = ((c.surrender_value / p.surrender_value) ** (month_days / days) - 1) * 100
                if not math.isnan(r):
                    out.append((cid, c.date, c.surrender_value, p.surrender_value, days, r))
    return pd.DataFrame(out, columns=["contractid", "date", "surrender_value", "previous_value", "days_diff", "rate"])


def random_series(seed=7, hot_rows=3000):
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(40):
        for _ in range(rng.integers(1, 30)):
            rows.append((f"V{c}", day(int(rng.integers(0, 400))), float(rng.integers(0, 50)) * 10.0))
    for _ in range(hot_rows):                                     # one contract with most of the rows
        rows.append(("HOT", day(int(rng.integers(0, 2000))), float(rng.integers(1, 300))))
    rows.append(("V1", None, 5.0))
    rows.append(("V2", day(3), None))
    return rows


def test_growth_equals_row_level_brute_force(spark):
    rows = random_series()
    got = series.calculate_monthly_growth(frame(spark, rows)).toPandas()
    exp = brute_growth(pd.DataFrame(rows, columns=["contractid", "date", "surrender_value"]))
    assert len(got) == len(exp)
    got = got.sort_values(["contractid", "date"]).reset_index(drop=True)
    exp = exp.sort_values(["contractid", "date"]).reset_index(drop=True)
    assert list(got.contractid) == list(exp.contractid)
    np.testing.assert_allclose(got.monthly_growth_rate, exp.rate, rtol=1e-12)
    np.testing.assert_allclose(got.previous_value, exp.previous_value)
    assert list(got.days_diff) == list(exp.days_diff)


def test_growth_independent_of_partitioning(spark):
    df = frame(spark, random_series(seed=3))
    a = series.calculate_monthly_growth(df.repartition(1)).toPandas().sort_values(["contractid", "date"])
    b = series.calculate_monthly_growth(df.repartition(13)).toPandas().sort_values(["contractid", "date"])
    pd.testing.assert_frame_equal(a.reset_index(drop=True), b.reset_index(drop=True))


def test_volatility_rules(spark):
    rows = [("K", day(30 * i), 100.0 * 1.01 ** i) for i in range(8)]       # constant growth
    rows += [("F", day(30 * i), 100.0 + i) for i in range(6)]               # 5 rates only
    v = {r.contractid: r for r in series.calculate_volatility(
        series.calculate_monthly_growth(frame(spark, rows))).collect()}
    assert "F" not in v
    assert v["K"].volatility == 0.0 and v["K"].risk_adjusted_return is None
    assert v["K"].volatility_class == "Niedrig"


@pytest.mark.parametrize("r,label", [(0.3, "Mittel"), (0.6, "Hoch"), (0.8, "Sehr hoch"), (1.0, "Sehr hoch"),
                                     (0.0, "Niedrig")])
def test_sensitivity_classes(spark, r, label):
    df = spark.createDataFrame([(r,)], "r double")
    got = df.select(bin_left_closed("r", series.SENSITIVITY_BREAKS, series.CLASS_LABELS, include_last=True)).first()[0]
    assert got == label
    ref = df.select(bin_left_closed("r", series.SENSITIVITY_BREAKS, series.CLASS_LABELS)).first()[0]
    assert ref == (None if r == 1.0 else label)                     # X7: reference bins leave 1 unclassed


def test_sensitivity_matches_numpy(spark):
    rng = np.random.default_rng(1)
    ts, rates = [], []
    for m in range(24):
        d = dt.date(2020 + m // 12, m % 12 + 1, 15)
        rates.append((d, float(rng.normal(1, 0.3))))
        for c in ("A", "B"):
            ts.append((c, d, float(1000 + 10 * m + rng.normal(0, 5))))
    ts.append(("CONST", dt.date(2020, 1, 15), 5.0))
    s = {r.contractid: r for r in series.calculate_interest_sensitivity(
        frame(spark, ts), spark.createDataFrame(rates, "date date, interest_rate double"),
        digits=(None, None, None)).collect()}
    assert set(s) == {"A", "B"}
    x = np.array([r for _, r in rates])
    y = np.array([v for c, _, v in ts if c == "A"])
    assert s["A"].correlation == pytest.approx(np.corrcoef(x, y)[0, 1], rel=1e-9)
    assert s["A"].beta_coefficient == pytest.approx(np.polyfit(x, y, 1)[0], rel=1e-9)
    assert s["A"].r_squared == pytest.approx(np.corrcoef(x, y)[0, 1] ** 2, rel=1e-9)
