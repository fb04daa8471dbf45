"""Contract value series analytics (T1-T19): growth, volatility, interest sensitivity.

Scale notes
-----------
* Growth (T3) keeps only rates whose gap is positive (X8): of several rows on one day
  only the first in ``(date, surrender_value)`` order can have a predecessor on an
  earlier day. So the lag runs on one row per ``(contract, day)`` (first and last value
  of the day), built by a partial aggregate. A contract's window partition then holds
  at most one row per calendar day, even when one contract holds a third of all rows.
* Volatility and sensitivity are per-contract partial aggregates (count, moments,
  co-moments), so hot contracts are combined map-side.
* Monthly rates have one row per calendar month: at most 12 x 9999 rows for any DATE
  column, a proven bound that makes the broadcast join on ``year_month`` safe.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import require
from ..functions.stats import (bin_left_closed, one_row, percent_of_total, quantiles, rnd,
                               safe_corr, safe_r2, safe_slope)

# Class labels and breaks of the volatility and sensitivity classes,
# and of the variant classifications.
CLASS_LABELS = ("Niedrig", "Mittel", "Hoch", "Sehr hoch")
VOLATILITY_BREAKS = (0.0, 1.0, 3.0, 5.0, math.inf)
SENSITIVITY_BREAKS = (0.0, 0.3, 0.6, 0.8, 1.0)
VARIANT_VOLATILITY_UPPER = (2.0, 5.0, 10.0)      # <=2, <=5, <=10, else
TREND_UPPER = (0.2, 0.4, 0.7)                    # <=.2, <=.4, <=.7, else
HIGH_CLASSES = ("Hoch", "Sehr hoch")
EPOCH = dt.date(1970, 1, 1)

SERIES_COLS = ("contractid", "date", "surrender_value")


def series_input(ts: DataFrame, positive_only: bool = False) -> DataFrame:
    """Rows with contract, date and value present (variant: value > 0, id not empty)."""
    require(ts, SERIES_COLS, "timeseries")
    out = ts.select(*SERIES_COLS).dropna(subset=list(SERIES_COLS))
    if positive_only:
        out = out.where((F.col("surrender_value") > 0) & (F.col("contractid") != ""))
    return out


def contract_days(ts: DataFrame) -> DataFrame:
    """One row per (contract, day): rows, first and last value of the day."""
    return ts.groupBy("contractid", "date").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("surrender_value").alias("_first"),
        F.max("surrender_value").alias("_last"),
    )


def calculate_monthly_growth(ts: DataFrame, min_observations: int = 3, month_days: float = 30.0,
                             positive_only: bool = False, min_rates: int | None = None) -> DataFrame:
    """T2+T3 (T15 with ``min_observations=0, month_days=30.44, positive_only=True, min_rates=3``).

    rate = ((v / prev) ^ (month_days / days) - 1) * 100 where prev > 0 and days > 0;
    contracts need ``min_observations`` rows before the lag (``min_rates`` rates after).
    Columns: contractid, date, surrender_value, previous_value, days_diff,
    monthly_growth_rate, absolute_change.
    """
    days = contract_days(series_input(ts, positive_only))
    by_contract = Window.partitionBy("contractid")
    ordered = by_contract.orderBy("date")
    g = (days
         .withColumn("_n", F.sum("_rows").over(by_contract))
         .withColumn("previous_value", F.lag("_last").over(ordered))
         .withColumn("_prev_date", F.lag("date").over(ordered)))
    if min_observations:
        g = g.where(F.col("_n") >= min_observations)
    days_diff = F.datediff("date", "_prev_date")
    rate = F.when((F.col("previous_value") > 0) & (days_diff > 0),
                  (F.pow(F.col("_first") / F.col("previous_value"), F.lit(float(month_days)) / days_diff) - 1) * 100)
    g = g.select(
        "contractid", "date",
        F.col("_first").alias("surrender_value"),
        "previous_value",
        days_diff.cast("long").alias("days_diff"),
        rate.alias("monthly_growth_rate"),
        (F.col("_first") - F.col("previous_value")).alias("absolute_change"),
    ).where(F.col("monthly_growth_rate").isNotNull() & ~F.isnan("monthly_growth_rate"))
    if min_rates:
        g = (g.withColumn("_k", F.count(F.lit(1)).over(Window.partitionBy("contractid")))
             .where(F.col("_k") >= min_rates).drop("_k"))
    return g


def growth_stats(growth: DataFrame, ts: DataFrame | None = None, digits: int | None = 2,
                 accuracy: int | None = None) -> DataFrame:
    """T4: mean, median, sd, min, max of the rates; contracts and date span of the input.

    Contracts and the date span come from the complete-row input series (``ts``, T1), as
    the reference reports them before the group-size filter; without ``ts`` they come
    from the growth rows.
    """
    r = F.col("monthly_growth_rate")
    src = series_input(ts) if ts is not None else growth
    span = src.agg(F.countDistinct("contractid").alias("contracts"),
                   F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    agg = growth.agg(
        F.count(r).alias("rates"),
        rnd(F.avg(r), digits).alias("mean_rate"),
        rnd(F.stddev_samp(r), digits).alias("std_rate"),
        rnd(F.min(r), digits).alias("min_rate"),
        rnd(F.max(r), digits).alias("max_rate"),
    )
    med = quantiles(growth, [], "monthly_growth_rate", [0.5], ["median_rate"], accuracy)
    return one_row(agg, span, med.select(rnd("median_rate", digits).alias("median_rate")))


def calculate_volatility(growth: DataFrame, min_periods: int = 6, digits: int | None = 3) -> DataFrame:
    """T5+T6: per contract n, mean, sd, min, max, range, mean/sd and class.

    With ``digits`` the range and the ratio use the already rounded values and the class
    is cut on the rounded sd (the reference's order of operations).
    """
    require(growth, ["contractid", "monthly_growth_rate"], "growth")
    r = F.col("monthly_growth_rate")
    v = (growth.groupBy("contractid").agg(
            F.count(F.lit(1)).alias("observations"),
            rnd(F.avg(r), digits).alias("mean_growth_rate"),
            rnd(F.stddev_samp(r), digits).alias("volatility"),
            rnd(F.min(r), digits).alias("min_growth"),
            rnd(F.max(r), digits).alias("max_growth"))
         .where(F.col("observations") >= min_periods))
    v = v.withColumns({
        "growth_range": rnd(F.col("max_growth") - F.col("min_growth"), digits),
        "risk_adjusted_return": F.when(F.col("volatility") > 0,
                                       rnd(F.col("mean_growth_rate") / F.col("volatility"), digits)),
    })
    return v.withColumn("volatility_class",
                        bin_left_closed("volatility", VOLATILITY_BREAKS, CLASS_LABELS))


def volatility_variant(growth: DataFrame, min_periods: int = 6) -> DataFrame:
    """Unrounded; classes <=2, <=5, <=10, else; ratio 0 when sd = 0."""
    r = F.col("monthly_growth_rate")
    v = (growth.groupBy("contractid").agg(
            F.count(F.lit(1)).alias("observations"),
            F.avg(r).alias("mean_growth"),
            F.stddev_samp(r).alias("volatility"),
            F.min(r).alias("min_growth"),
            F.max(r).alias("max_growth"))
         .where((F.col("observations") >= min_periods) & F.col("volatility").isNotNull()))
    a, b, c = VARIANT_VOLATILITY_UPPER
    vol = F.col("volatility")
    return v.withColumns({
        "volatility_class": F.when(vol <= a, "Niedrig").when(vol <= b, "Mittel")
                             .when(vol <= c, "Hoch").otherwise("Sehr hoch"),
        "risk_adjusted_return": F.when(vol > 0, F.col("mean_growth") / vol).otherwise(F.lit(0.0)),
    })


def class_distribution(df: DataFrame, class_col: str, value_col: str, unit: str,
                       digits: int | None = 3, extra: dict | None = None,
                       accuracy: int | None = None) -> DataFrame:
    """Per class count and %, mean / median / max of ``value_col`` (+ extra aggregates)."""
    x = F.col(value_col)
    aggs = [F.count(F.lit(1)).alias(unit),
            rnd(F.avg(x), digits).alias(f"mean_{value_col}"),
            rnd(F.max(x), digits).alias(f"max_{value_col}")]
    for name, col in (extra or {}).items():
        aggs.append(rnd(col, digits).alias(name))
    kept = df.where(F.col(class_col).isNotNull())
    counts = kept.groupBy(class_col).agg(*aggs)
    med = quantiles(kept, [class_col], value_col, [0.5], [f"median_{value_col}"], accuracy)
    # both sides have one row per class label: the median side is a bounded broadcast
    out = counts.join(F.broadcast(med), class_col, "left").withColumn(
        f"median_{value_col}", rnd(f"median_{value_col}", digits))
    return out.withColumn("percentage", percent_of_total(unit))


def overall_stats(df: DataFrame, value_col: str, digits: int | None = 2, extra: dict | None = None,
                  accuracy: int | None = None) -> DataFrame:
    """T7/T13 overall figures: count, mean, exact median and max of ``value_col`` (+ extra)."""
    x = F.col(value_col)
    aggs = [F.count(x).alias("n"), rnd(F.avg(x), digits).alias(f"mean_{value_col}"),
            rnd(F.max(x), digits).alias(f"max_{value_col}")]
    for name, col in (extra or {}).items():
        aggs.append(rnd(col, digits).alias(name))
    med = quantiles(df, [], value_col, [0.5], [f"median_{value_col}"], accuracy)
    return one_row(df.agg(*aggs), med.select(rnd(f"median_{value_col}", digits).alias(f"median_{value_col}")))


def monthly_contract_values(ts: DataFrame) -> DataFrame:
    """Mean value per contract and month (month floor)."""
    return (ts.where(F.col("surrender_value").isNotNull())
            .groupBy("contractid", F.trunc("date", "month").alias("year_month"))
            .agg(F.avg("surrender_value").alias("avg_surrender_value")))


def monthly_rates(rates: DataFrame) -> DataFrame:
    """Mean rate per month (at most one row per calendar month)."""
    require(rates, ["date", "interest_rate"], "interest rates")
    return (rates.groupBy(F.trunc("date", "month").alias("year_month"))
            .agg(F.avg("interest_rate").alias("avg_interest_rate")))


def contract_rate_months(ts: DataFrame, rates: DataFrame) -> DataFrame:
    """Contract months joined with rate months (broadcast of the month table)."""
    return monthly_contract_values(ts).join(F.broadcast(monthly_rates(rates)), "year_month")


def calculate_interest_sensitivity(ts: DataFrame, rates: DataFrame, min_observations: int = 12,
                                   digits: Sequence[int | None] = (4, 2, 4),
                                   reference_bins: bool = False) -> DataFrame:
    """Per contract n, Pearson r, OLS slope value~rate, R^2 and class of |r|.

    Contracts need ``min_observations`` joined months; undefined r is removed. |r| = 1
    falls in the top class unless ``reference_bins`` (then it has no class, X7).
    """
    y, x = F.col("avg_surrender_value"), F.col("avg_interest_rate")
    dr, ds, d2 = digits
    s = (contract_rate_months(ts, rates).groupBy("contractid").agg(
            F.count(F.lit(1)).alias("observations"),
            safe_corr(y, x).alias("_r"),
            safe_slope(y, x).alias("_b"),
            safe_r2(y, x).alias("_r2"))
         .where((F.col("observations") >= min_observations) & F.col("_r").isNotNull() & ~F.isnan("_r")))
    s = s.select("contractid", "observations",
                 rnd("_r", dr).alias("correlation"),
                 rnd("_b", ds).alias("beta_coefficient"),
                 rnd("_r2", d2).alias("r_squared"))
    return s.withColumn("sensitivity_class",
                        bin_left_closed(F.abs(F.col("correlation")), SENSITIVITY_BREAKS, CLASS_LABELS,
                                        include_last=not reference_bins))


def trend_correlation(growth: DataFrame, min_rates: int = 12) -> DataFrame:
    """r(day number, growth rate) per contract with >= ``min_rates`` rates; classes <=.2/.4/.7."""
    t = F.datediff("date", F.lit(EPOCH)).cast("double")
    g = F.col("monthly_growth_rate")
    s = (growth.groupBy("contractid").agg(
            F.count(F.lit(1)).alias("observations"),
            safe_corr(g, t).alias("time_correlation"),
            F.avg(g).alias("mean_growth"))
         .where((F.col("observations") >= min_rates) & F.col("time_correlation").isNotNull()
                & ~F.isnan("time_correlation")))
    a, b, c = TREND_UPPER
    r = F.abs(F.col("time_correlation"))
    return s.select(
        "contractid",
        r.alias("correlation"),
        F.when(r <= a, "Niedrig").when(r <= b, "Mittel").when(r <= c, "Hoch").otherwise("Sehr hoch")
         .alias("sensitivity_class"),
        (r * r).alias("r_squared"),
        "time_correlation",
    )


def top_n(df: DataFrame, by: str, n: int = 5, cols: Sequence[str] | None = None) -> DataFrame:
    """Top ``n`` by ``by`` desc, ties by contractid (TakeOrderedAndProject)."""
    out = df.orderBy(F.col(by).desc(), F.col("contractid").asc()).limit(n)
    return out.select(*cols) if cols else out


def month_spine(ts: DataFrame) -> DataFrame:
    """Every month from the first to the last series month, with rows and contracts.

    The spine is one row per month (bounded by the calendar); months without data stay
    listed with zero rows.
    """
    m = F.trunc("date", "month")
    bounds = ts.agg(F.min(m).alias("_lo"), F.max(m).alias("_hi"))
    spine = bounds.select(F.explode(F.sequence("_lo", "_hi", F.expr("INTERVAL 1 MONTH"))).alias("year_month"))
    counts = ts.groupBy(m.alias("year_month")).agg(
        F.count(F.lit(1)).alias("observations"),
        F.countDistinct("contractid").alias("contracts"))
    # counts are grouped by month: at most one row per calendar month, a bounded broadcast
    return (spine.join(F.broadcast(counts), "year_month", "left")
            .select("year_month",
                    F.coalesce("observations", F.lit(0)).cast("long").alias("observations"),
                    F.coalesce("contracts", F.lit(0)).cast("long").alias("contracts")))
