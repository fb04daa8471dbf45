"""Registered rate-series checks (S5, R1-R16) and their per-contract forms (key = contractid)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions import rules
from ..operators import rates
from ..sources import fixtures as fx
from ..sources import io
from .oracle import AS_OF, q
from .registry import register

INTAKE_START = rules.MIN_SERIES_DATE
CONTRACT_JUMP = 1000.0
NUMERIC = ("interest_rate", "avg_rate", "data_points")

RATE_CTES = f"""
intake AS (SELECT CAST(date AS DATE) AS date, CAST(interest_rate AS DOUBLE) AS close FROM daily_rates
           WHERE interest_rate IS NOT NULL AND CAST(date AS DATE) BETWEEN DATE '1990-01-01' AND {AS_OF}),
mclose AS (SELECT strftime(date, '%Y-%m') AS year_month, max(date) AS date,
                  round(arg_max(close, date), 2) AS interest_rate FROM intake GROUP BY 1),
roll AS (SELECT strftime(date, '%Y-%m') AS year_month, max(date) AS date, arg_max(interest_rate, date) AS interest_rate,
                avg(interest_rate) AS avg_rate, count(*) AS data_points
         FROM daily_rates WHERE interest_rate IS NOT NULL GROUP BY 1)
"""


def _roll(spark, d):
    return rates.monthly_rollup(fx.daily_rates(spark, d))


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def _fin(x):
    return f"({x} IS NOT NULL AND NOT isnan({x}) AND abs({x}) <> 'inf'::DOUBLE)"


@register("rate_intake", q("SELECT * FROM intake", RATE_CTES))
def rate_intake(spark, d):
    """Daily (date, close), NULL close dropped, dates bounded."""
    return io.daily_rate_intake(fx.daily_close(spark, d), INTAKE_START, fx.AS_OF)


@register("monthly_close", q("SELECT * FROM mclose", RATE_CTES))
def monthly_close(spark, d):
    """R1+R2: month key, last trading date and close per month."""
    return rates.monthly_close(io.daily_rate_intake(fx.daily_close(spark, d), INTAKE_START, fx.AS_OF))


@register("rate_rollup", q("""
SELECT year_month, date, interest_rate, round(avg_rate, 10) AS avg_rate, data_points FROM roll""", RATE_CTES))
def rate_rollup(spark, d):
    """Monthly roll-up with last rate, mean rate (shown at 10 decimals) and data points."""
    return _roll(spark, d).withColumn("avg_rate", F.round("avg_rate", 10))


@register("rate_summary", q("""
SELECT count(*) AS points, min(date) AS first_date, max(date) AS last_date, min(interest_rate) AS min_rate,
       max(interest_rate) AS max_rate FROM roll""", RATE_CTES))
def rate_summary(spark, d):
    """Points, date range and rate range."""
    return rates.series_summary(_roll(spark, d))


@register("rate_head_tail", q("""
SELECT * FROM (SELECT year_month, date, interest_rate, 'first' AS part FROM roll ORDER BY date LIMIT 5)
UNION ALL
SELECT * FROM (SELECT year_month, date, interest_rate, 'last' AS part FROM roll ORDER BY date DESC LIMIT 5)""",
                              RATE_CTES))
def rate_head_tail(spark, d):
    """First and last five months."""
    return rates.head_tail(_roll(spark, d).select("year_month", "date", "interest_rate"))


_MISS = {"year_month": "(year_month IS NULL OR year_month IN ('', 'NULL', 'null'))",
         "date": "(date IS NULL)",
         "interest_rate": f"(NOT {_fin('interest_rate')})",
         "avg_rate": f"(NOT {_fin('avg_rate')})",
         "data_points": "(data_points IS NULL)"}


@register("rate_missing", q(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if({e}) AS BIGINT) AS missing, "
    f"round(100.0 * count_if({e}) / count(*), 1) AS missing_percent FROM roll" for c, e in _MISS.items()),
    RATE_CTES))
def rate_missing(spark, d):
    """Type-aware missing values per column."""
    return rates.typed_missing(_roll(spark, d))


@register("rate_dates", q(f"""
SELECT 'date' AS "column", min(date) AS min_date, max(date) AS max_date,
       CAST(count_if(date > {AS_OF}) AS BIGINT) AS future_dates,
       CAST(count_if(date < DATE '1900-01-01') AS BIGINT) AS dates_before_1900 FROM roll""", RATE_CTES))
def rate_dates(spark, d):
    """Date range, future dates, dates before 1900."""
    return rates.date_checks(_roll(spark, d), fx.AS_OF)


@register("rate_gaps", q("""
SELECT count(*) AS dates, CAST(count_if(step > 35) AS BIGINT) AS large_gaps, max(step) AS max_gap_days
FROM (SELECT d, date_diff('day', lag(d) OVER (ORDER BY d), d) AS step
      FROM (SELECT DISTINCT CAST(date AS DATE) AS d FROM roll WHERE date IS NOT NULL) a) b""", RATE_CTES))
def rate_gaps(spark, d):
    """Gaps of more than 35 days between consecutive dates."""
    return rates.gaps(_roll(spark, d)).withColumn("max_gap_days", F.col("max_gap_days").cast("long"))


def _stats_sql(col):
    x = f"CAST({col} AS DOUBLE)"
    return (f"SELECT '{col}' AS \"column\", count(*) AS n, round(min(x), 4) AS min, round(max(x), 4) AS max, "
            f"round(avg(x), 4) AS mean, round(stddev_samp(x), 4) AS sd, round(median(x), 4) AS median "
            f"FROM (SELECT {x} AS x FROM roll) s WHERE {_fin('x')}")


@register("rate_stats", q(" UNION ALL ".join(_stats_sql(c) for c in NUMERIC), RATE_CTES))
def rate_stats(spark, d):
    """Finite min, max, mean, median, sd per numeric column."""
    r = _roll(spark, d)
    return _union([rates.numeric_stats(r, c).select(F.lit(c).alias("column"), "*") for c in NUMERIC])


@register("rate_negatives", q(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(count_if({_fin(c)} AND {c} < 0) AS BIGINT) AS negatives FROM roll"
    for c in ("interest_rate", "avg_rate")), RATE_CTES))
def rate_negatives(spark, d):
    """Negative values in rate-named columns."""
    return rates.negatives(_roll(spark, d))


def _outlier_sql(col, frame="roll", key=None):
    x = f"CAST({col} AS DOUBLE)"
    if key is None:
        return (f"SELECT '{col}' AS \"column\", count(*) AS n, "
                f"CASE WHEN count(*) > 10 THEN CAST(count_if(abs(x - m) > 3 * s) AS BIGINT) END AS outliers "
                f"FROM (SELECT x, avg(x) OVER () AS m, stddev_samp(x) OVER () AS s "
                f"FROM (SELECT {x} AS x FROM {frame}) a WHERE {_fin('x')}) b")
    return (f"SELECT {key}, count(*) AS n, "
            f"CASE WHEN count(*) > 10 THEN CAST(count_if(abs(x - m) > 3 * s) AS BIGINT) END AS outliers "
            f"FROM (SELECT {key}, x, avg(x) OVER (PARTITION BY {key}) AS m, stddev_samp(x) OVER (PARTITION BY {key}) AS s "
            f"FROM (SELECT {key}, {x} AS x FROM {frame}) a WHERE {_fin('x')}) b GROUP BY {key}")


@register("rate_outliers", q(" UNION ALL ".join(_outlier_sql(c) for c in NUMERIC), RATE_CTES))
def rate_outliers(spark, d):
    """Values beyond 3 sd of the mean, where n > 10."""
    r = _roll(spark, d)
    return _union([rates.outliers(r, c).select(F.lit(c).alias("column"), "*") for c in NUMERIC])


@register("rate_constant", q(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(x) AS finite, CAST(CASE WHEN count(x) = 0 THEN 1 "
    f"WHEN stddev_samp(x) < 0.001 THEN 1 ELSE 0 END AS BIGINT) AS issues "
    f"FROM (SELECT CASE WHEN {_fin(f'CAST({c} AS DOUBLE)')} THEN CAST({c} AS DOUBLE) END AS x FROM roll) s"
    for c in NUMERIC), RATE_CTES))
def rate_constant(spark, d):
    """Near-constant or all-invalid numeric columns."""
    return rates.constant_or_empty(_roll(spark, d))


@register("rate_recency", q(f"""
SELECT max(date) AS latest_date, date_diff('day', max(date), {AS_OF}) AS days_old,
       CASE WHEN date_diff('day', max(date), {AS_OF}) > 30 THEN 'stale'
            WHEN date_diff('day', max(date), {AS_OF}) > 7 THEN 'aged' ELSE 'fresh' END AS recency FROM roll""",
                            RATE_CTES))
def rate_recency(spark, d):
    """Days since the latest rate and staleness class."""
    return rates.recency(_roll(spark, d), fx.AS_OF)


@register("rate_bounds", q("""
SELECT count(*) AS rates, CAST(count_if(interest_rate < -5 OR interest_rate > 25) AS BIGINT) AS out_of_bounds
FROM roll WHERE interest_rate IS NOT NULL""", RATE_CTES))
def rate_bounds(spark, d):
    """Rates outside -5 .. 25."""
    return rates.bounds(_roll(spark, d))


def _jump_sql(value, frame, threshold, key=None):
    part = f"PARTITION BY {key} " if key else ""
    sel = f"{key}, " if key else ""
    grp = f" GROUP BY {key}" if key else ""
    return (f"SELECT {sel}count(*) AS points, CAST(count_if(abs(c) > {threshold}) AS BIGINT) AS large_jumps, "
            f"round(max(abs(c)), 6) AS max_change FROM (SELECT {sel}v - lag(v) OVER ({part}ORDER BY d) AS c FROM "
            f"(SELECT {sel}CAST(date AS DATE) AS d, avg({value}) AS v FROM {frame} "
            f"WHERE {value} IS NOT NULL AND date IS NOT NULL GROUP BY {sel}CAST(date AS DATE)) a) b{grp}")


@register("rate_jumps", q(_jump_sql("interest_rate", "roll", 2.0), RATE_CTES))
def rate_jumps(spark, d):
    """Month-to-month rate changes above 2 points."""
    return rates.jumps(_roll(spark, d), "interest_rate").withColumn("max_change", F.round("max_change", 6))


@register("rate_status", q(f"""
SELECT CAST(m + 0 + o + c AS BIGINT) AS issues, CAST(0 AS BIGINT) AS missing_columns, CAST(m AS BIGINT) AS missing_values,
       CAST(o AS BIGINT) AS dates_before_1900, CAST(c AS BIGINT) AS constant_or_empty_columns,
       CASE WHEN m + o + c = 0 THEN 'excellent' WHEN m + o + c < 10 THEN 'minor' ELSE 'major' END AS status
FROM (SELECT {' + '.join(f'count_if({e})' for e in _MISS.values())} AS m,
             count_if(date < DATE '1900-01-01') AS o,
             {' + '.join(f"(CASE WHEN count(CASE WHEN {_fin(f'CAST({c} AS DOUBLE)')} THEN 1 END) = 0 THEN 1 "
                         f"WHEN stddev_samp(CASE WHEN {_fin(f'CAST({c} AS DOUBLE)')} THEN CAST({c} AS DOUBLE) END) "
                         f"< 0.001 THEN 1 ELSE 0 END)" for c in NUMERIC)} AS c
      FROM roll) s""", RATE_CTES))
def rate_status(spark, d):
    """Rate-table issue count and status tier."""
    return rates.rate_quality(_roll(spark, d), fx.AS_OF)


# ------------------------------------------------------------------ per contract

@register("contract_gaps", q("""
SELECT contractid, count(*) AS dates, CAST(count_if(step > 35) AS BIGINT) AS large_gaps, max(step) AS max_gap_days
FROM (SELECT contractid, d, date_diff('day', lag(d) OVER (PARTITION BY contractid ORDER BY d), d) AS step
      FROM (SELECT DISTINCT contractid, date AS d FROM timeseries WHERE date IS NOT NULL) a) b
GROUP BY contractid""", whole_series=True), headline=True)
def contract_gaps(spark, d):
    """R8 per contract: gaps of more than 35 days in each contract's series."""
    return rates.gaps(fx.whole_timeseries(spark, d), key="contractid").withColumn(
        "max_gap_days", F.col("max_gap_days").cast("long"))


@register("contract_outliers", q(_outlier_sql("surrender_value", "timeseries", "contractid"), whole_series=True))
def contract_outliers(spark, d):
    """R11 per contract: values beyond 3 sd of the contract mean, where n > 10."""
    return rates.outliers(fx.whole_timeseries(spark, d), "surrender_value", key="contractid")


@register("contract_jumps", q(_jump_sql("surrender_value", "timeseries", CONTRACT_JUMP, "contractid"), whole_series=True))
def contract_jumps(spark, d):
    """R15 per contract: day-to-day changes of the daily mean value above 1000."""
    return rates.jumps(fx.whole_timeseries(spark, d), "surrender_value", key="contractid",
                       threshold=CONTRACT_JUMP).withColumn("max_change", F.round("max_change", 6))


@register("contract_recency", q(f"""
SELECT contractid, max(date) AS latest_date, date_diff('day', max(date), {AS_OF}) AS days_old,
       CASE WHEN date_diff('day', max(date), {AS_OF}) > 30 THEN 'stale'
            WHEN date_diff('day', max(date), {AS_OF}) > 7 THEN 'aged' ELSE 'fresh' END AS recency
FROM timeseries GROUP BY contractid""", whole_series=True))
def contract_recency(spark, d):
    """R13 per contract: days since the latest observation."""
    return rates.recency(fx.whole_timeseries(spark, d), fx.AS_OF, key="contractid")


@register("contract_value_stats", q("""
SELECT contractid, count(*) AS n, round(min(x), 4) AS min, round(max(x), 4) AS max, round(avg(x), 4) AS mean,
       round(stddev_samp(x), 4) AS sd, round(median(x), 4) AS median
FROM (SELECT contractid, CAST(surrender_value AS DOUBLE) AS x FROM timeseries) s
WHERE x IS NOT NULL AND NOT isnan(x) AND abs(x) <> 'inf'::DOUBLE GROUP BY contractid"""))
def contract_value_stats(spark, d):
    """R9 per contract: finite min, max, mean, exact median, sd of the surrender value."""
    return rates.numeric_stats(fx.timeseries(spark, d), "surrender_value", key="contractid")


