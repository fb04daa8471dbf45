"""Registered series, tenant and combined queries.

The growth oracle is the literal row-level form (lag over ``(date, surrender_value)``
per contract, rate only where the gap is positive), an independent check of the
contract-day formulation used on the Spark side.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import label_rank
from ..operators import age, insights, series, tenant
from ..sources import fixtures as fx
from .oracle import CLASSIFIED, q
from .registry import register

AS_OF = fx.AS_OF
CL = series.CLASS_LABELS


# ------------------------------------------------------------------ Spark inputs

def _ts(spark, d):
    return fx.timeseries(spark, d)


def _growth(spark, d):
    return _plain_growth(_ts(spark, d))


def _plain_growth(ts):
    return series.calculate_monthly_growth(ts)


def _vol(spark, d):
    return series.calculate_volatility(_growth(spark, d))


def _sens(spark, d):
    return series.calculate_interest_sensitivity(_ts(spark, d), fx.daily_rates(spark, d))


def _classified(spark, d):
    return age.classify_age_groups(fx.customers(spark, d), AS_OF)


def _gv(spark, d):
    """The variant growth the demo analyses (T16-T19, D3, D6, D7) run on."""
    return _variant_growth(_ts(spark, d))


def _variant_growth(ts):
    return series.calculate_monthly_growth(ts, min_observations=0, month_days=30.44, positive_only=True, min_rates=3)


def _vv(spark, d):
    """The variant volatility."""
    return series.volatility_variant(_gv(spark, d))


# ------------------------------------------------------------------ SQL pieces

def _growth_cte(month_days="30.0", positive=False, min_obs=3, min_rates=None, name="growth"):
    pos = " AND surrender_value > 0 AND contractid <> ''" if positive else ""
    rates_filter = (f"SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY contractid) AS k FROM {name}_r) z "
                    f"WHERE k >= {min_rates}") if min_rates else f"SELECT * FROM {name}_r"
    return f"""
{name}_t1 AS (SELECT contractid, date, surrender_value FROM timeseries
              WHERE contractid IS NOT NULL AND date IS NOT NULL AND surrender_value IS NOT NULL{pos}),
{name}_t2 AS (SELECT *, count(*) OVER (PARTITION BY contractid) AS n FROM {name}_t1),
{name}_t3 AS (SELECT contractid, date, surrender_value,
              lag(surrender_value) OVER (PARTITION BY contractid ORDER BY date, surrender_value) AS previous_value,
              lag(date) OVER (PARTITION BY contractid ORDER BY date, surrender_value) AS prev_date
              FROM {name}_t2 WHERE n >= {min_obs}),
{name}_r AS (SELECT contractid, date, surrender_value, previous_value, days_diff,
                CASE WHEN previous_value > 0 AND days_diff > 0
                     THEN (pow(surrender_value / previous_value, {month_days} / days_diff) - 1) * 100 END AS monthly_growth_rate,
                surrender_value - previous_value AS absolute_change
             FROM (SELECT *, date_diff('day', prev_date, date) AS days_diff FROM {name}_t3) t
             WHERE CASE WHEN previous_value > 0 AND days_diff > 0
                        THEN (pow(surrender_value / previous_value, {month_days} / days_diff) - 1) * 100 END IS NOT NULL),
{name} AS (SELECT contractid, date, surrender_value, previous_value, days_diff, monthly_growth_rate, absolute_change
           FROM ({rates_filter}) y WHERE NOT isnan(monthly_growth_rate))
"""


def _cut_sql(col, breaks, labels, include_last=False):
    parts = []
    for i, lab in enumerate(labels):
        lo, hi = breaks[i], breaks[i + 1]
        cond = f"{col} >= {lo}"
        if hi != float("inf"):
            op = "<=" if include_last and i == len(labels) - 1 else "<"
            cond += f" AND {col} {op} {hi}"
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


GROWTH = _growth_cte()
VOL = GROWTH + f""",
vol_a AS (SELECT contractid, count(*) AS observations, round(avg(monthly_growth_rate), 3) AS mean_growth_rate,
                 round(stddev_samp(monthly_growth_rate), 3) AS volatility,
                 round(min(monthly_growth_rate), 3) AS min_growth, round(max(monthly_growth_rate), 3) AS max_growth
          FROM growth GROUP BY contractid HAVING count(*) >= 6),
vol AS (SELECT *, round(max_growth - min_growth, 3) AS growth_range,
               CASE WHEN volatility > 0 THEN round(mean_growth_rate / volatility, 3) END AS risk_adjusted_return,
               {_cut_sql('volatility', series.VOLATILITY_BREAKS, CL)} AS volatility_class
        FROM vol_a)
"""
GV = _growth_cte("30.44", True, 0, 3, "gv")
VV = GV + """,
vv_a AS (SELECT contractid, count(*) AS observations, avg(monthly_growth_rate) AS mean_growth,
                stddev_samp(monthly_growth_rate) AS volatility, min(monthly_growth_rate) AS min_growth,
                max(monthly_growth_rate) AS max_growth
         FROM gv GROUP BY contractid),
vv AS (SELECT contractid, observations, mean_growth, volatility, min_growth, max_growth,
              CASE WHEN volatility <= 2 THEN 'Niedrig' WHEN volatility <= 5 THEN 'Mittel'
                   WHEN volatility <= 10 THEN 'Hoch' ELSE 'Sehr hoch' END AS volatility_class,
              CASE WHEN volatility > 0 THEN mean_growth / volatility ELSE 0.0 END AS risk_adjusted_return
       FROM vv_a WHERE observations >= 6 AND volatility IS NOT NULL)
"""
SENS = """
mv AS (SELECT contractid, date_trunc('month', date) AS year_month, avg(surrender_value) AS avg_surrender_value
       FROM timeseries WHERE surrender_value IS NOT NULL GROUP BY contractid, date_trunc('month', date)),
mr AS (SELECT date_trunc('month', date) AS year_month, avg(interest_rate) AS avg_interest_rate
       FROM daily_rates GROUP BY date_trunc('month', date)),
cm AS (SELECT mv.contractid, mv.year_month, mv.avg_surrender_value, mr.avg_interest_rate
       FROM mv JOIN mr ON mv.year_month = mr.year_month),
sens_a AS (
  SELECT contractid, count(*) AS observations,
         CASE WHEN min(avg_surrender_value) < max(avg_surrender_value) AND min(avg_interest_rate) < max(avg_interest_rate)
              THEN corr(avg_surrender_value, avg_interest_rate) END AS r,
         CASE WHEN min(avg_interest_rate) < max(avg_interest_rate)
              THEN regr_slope(avg_surrender_value, avg_interest_rate) END AS b,
         CASE WHEN min(avg_surrender_value) < max(avg_surrender_value) AND min(avg_interest_rate) < max(avg_interest_rate)
              THEN regr_r2(avg_surrender_value, avg_interest_rate) END AS r2
  FROM cm GROUP BY contractid HAVING count(*) >= 12),
sens AS (SELECT contractid, observations, round(r, 4) AS correlation, round(b, 2) AS beta_coefficient,
                round(r2, 4) AS r_squared,
                """ + _cut_sql("abs(round(r, 4))", series.SENSITIVITY_BREAKS, CL, include_last=True) + """ AS sensitivity_class
         FROM sens_a WHERE r IS NOT NULL AND NOT isnan(r))
"""


# ------------------------------------------------------------------ series queries

GROWTH_OUT = ("SELECT contractid, date, surrender_value, previous_value, days_diff, "
              "round(monthly_growth_rate, 6) AS monthly_growth_rate, absolute_change FROM {}")


def _present(g):
    """Registered growth rows show the rate at 6 decimals (both engines agree bit for bit)."""
    return g.withColumn("monthly_growth_rate", F.round("monthly_growth_rate", 6))


@register("growth", q(GROWTH_OUT.format("growth"), GROWTH, whole_series=True), headline=True)
def growth(spark, d):
    """Monthly growth rate per contract observation (gap > 0)."""
    return _present(_plain_growth(fx.whole_timeseries(spark, d)))


@register("growth_stats", q("""
SELECT count(monthly_growth_rate) AS rates,
       (SELECT count(DISTINCT contractid) FROM growth_t1) AS contracts,
       round(avg(monthly_growth_rate), 2) AS mean_rate, round(stddev_samp(monthly_growth_rate), 2) AS std_rate,
       round(min(monthly_growth_rate), 2) AS min_rate, round(max(monthly_growth_rate), 2) AS max_rate,
       (SELECT min(date) FROM growth_t1) AS first_date, (SELECT max(date) FROM growth_t1) AS last_date,
       round(median(monthly_growth_rate), 2) AS median_rate
FROM growth""", GROWTH, whole_series=True))
def growth_stats(spark, d):
    """T4: mean, median, sd, min, max rate; contracts and date span of the input series."""
    ts = fx.whole_timeseries(spark, d)
    return series.growth_stats(_plain_growth(ts), ts)


@register("growth_variant", q(GROWTH_OUT.format("gv"), GV, whole_series=True))
def growth_variant(spark, d):
    """Positive values only, exponent 30.44 / days, at least 3 rates per contract."""
    return _present(_variant_growth(fx.whole_timeseries(spark, d)))


@register("growth_sample", q("""
SELECT contractid, date, surrender_value, round(monthly_growth_rate, 6) AS monthly_growth_rate FROM gv
ORDER BY contractid, date LIMIT 5""", GV))
def growth_sample(spark, d):
    """The first five variant growth rows in (contract, date) order."""
    return (_present(_gv(spark, d)).orderBy("contractid", "date").limit(5)
            .select("contractid", "date", "surrender_value", "monthly_growth_rate"))


@register("volatility", q("SELECT * FROM vol", VOL), headline=True)
def volatility(spark, d):
    """T5+T6: per-contract volatility of the growth rate and its class."""
    return _vol(spark, d)


@register("volatility_distribution", q("""
SELECT volatility_class, count(*) AS contracts, round(avg(volatility), 3) AS mean_volatility,
       round(max(volatility), 3) AS max_volatility, round(median(volatility), 3) AS median_volatility,
       round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS percentage
FROM vol WHERE volatility_class IS NOT NULL GROUP BY volatility_class""", VOL))
def volatility_distribution(spark, d):
    """Contracts per volatility class, share, mean / median / max volatility."""
    return series.class_distribution(_vol(spark, d), "volatility_class", "volatility", "contracts")


@register("volatility_overall", q("""
SELECT count(volatility) AS n, round(avg(volatility), 2) AS mean_volatility, round(max(volatility), 2) AS max_volatility,
       round(median(volatility), 2) AS median_volatility FROM vol""", VOL))
def volatility_overall(spark, d):
    """Mean, median and max volatility over all contracts (2 decimals)."""
    return series.overall_stats(_vol(spark, d), "volatility")


@register("volatility_variant", q("""
SELECT contractid, observations, round(mean_growth, 6) AS mean_growth, round(volatility, 6) AS volatility,
       round(min_growth, 6) AS min_growth, round(max_growth, 6) AS max_growth, volatility_class,
       round(risk_adjusted_return, 6) AS risk_adjusted_return
FROM vv""", VV))
def volatility_variant(spark, d):
    """Unrounded volatility of the variant growth, classes <=2 / <=5 / <=10 / above (shown at 6 dp)."""
    return _vv(spark, d).withColumns({c: F.round(c, 6) for c in ("mean_growth", "volatility", "min_growth",
                                                                 "max_growth", "risk_adjusted_return")})


@register("top_volatile", q("""
SELECT contractid, round(volatility, 6) AS volatility, volatility_class,
       round(risk_adjusted_return, 6) AS risk_adjusted_return
FROM (SELECT * FROM vv ORDER BY volatility DESC, contractid LIMIT 5) t""", VV))
def top_volatile(spark, d):
    """The five most volatile contracts of the variant volatility (shown at 6 dp)."""
    top = series.top_n(_vv(spark, d), "volatility", 5,
                       ["contractid", "volatility", "volatility_class", "risk_adjusted_return"])
    return top.withColumns({c: F.round(c, 6) for c in ("volatility", "risk_adjusted_return")})


@register("sensitivity", q("SELECT * FROM sens", SENS), headline=True)
def sensitivity(spark, d):
    """Per-contract correlation / slope / R^2 of monthly value on monthly rate."""
    return _sens(spark, d)


@register("sensitivity_distribution", q("""
SELECT sensitivity_class, count(*) AS contracts, round(avg(correlation), 3) AS mean_correlation,
       round(max(correlation), 3) AS max_correlation, round(avg(r_squared), 3) AS mean_r_squared,
       round(median(correlation), 3) AS median_correlation,
       round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS percentage
FROM sens WHERE sensitivity_class IS NOT NULL GROUP BY sensitivity_class""", SENS))
def sensitivity_distribution(spark, d):
    """Contracts per sensitivity class, share, mean / median r, mean R^2."""
    return series.class_distribution(_sens(spark, d), "sensitivity_class", "correlation", "contracts",
                                     extra={"mean_r_squared": F.avg("r_squared")})


@register("sensitivity_overall", q("""
SELECT count(correlation) AS n, round(avg(correlation), 3) AS mean_correlation,
       round(max(correlation), 3) AS max_correlation, round(avg(r_squared), 3) AS mean_r_squared,
       round(median(correlation), 3) AS median_correlation FROM sens""", SENS))
def sensitivity_overall(spark, d):
    """Mean and median correlation and mean R^2 over all contracts (3 decimals)."""
    return series.overall_stats(_sens(spark, d), "correlation", digits=3,
                                extra={"mean_r_squared": F.avg("r_squared")})


@register("monthly_contract_values", q("SELECT * FROM mv", SENS))
def monthly_contract_values(spark, d):
    """Mean surrender value per contract and month."""
    return series.monthly_contract_values(_ts(spark, d))


@register("monthly_rates", q("SELECT year_month, round(avg_interest_rate, 10) AS avg_interest_rate FROM mr", SENS))
def monthly_rates(spark, d):
    """Mean interest rate per month (shown at 10 decimals)."""
    return series.monthly_rates(fx.daily_rates(spark, d)).withColumn(
        "avg_interest_rate", F.round("avg_interest_rate", 10))


@register("contract_rate_months", q("""
SELECT contractid, year_month, avg_surrender_value, round(avg_interest_rate, 10) AS avg_interest_rate FROM cm""", SENS))
def contract_rate_months(spark, d):
    """Contract months joined with rate months (rate shown at 10 decimals)."""
    return series.contract_rate_months(_ts(spark, d), fx.daily_rates(spark, d)).withColumn(
        "avg_interest_rate", F.round("avg_interest_rate", 10))


_TREND = """
tr_a AS (SELECT contractid, count(*) AS observations,
                CASE WHEN min(monthly_growth_rate) < max(monthly_growth_rate) AND min(date) < max(date)
                     THEN corr(monthly_growth_rate, CAST(date_diff('day', DATE '1970-01-01', date) AS DOUBLE)) END AS tc
         FROM gv GROUP BY contractid HAVING count(*) >= 12),
trend_raw AS (SELECT contractid, abs(tc) AS correlation,
                     CASE WHEN abs(tc) <= 0.2 THEN 'Niedrig' WHEN abs(tc) <= 0.4 THEN 'Mittel'
                          WHEN abs(tc) <= 0.7 THEN 'Hoch' ELSE 'Sehr hoch' END AS sensitivity_class,
                     abs(tc) * abs(tc) AS r_squared, tc AS time_correlation
              FROM tr_a WHERE tc IS NOT NULL AND NOT isnan(tc)),
trend AS (SELECT contractid, round(correlation, 6) AS correlation, sensitivity_class,
                 round(r_squared, 6) AS r_squared, round(time_correlation, 6) AS time_correlation FROM trend_raw)
"""
TREND = GV + "," + _TREND


def _trend(spark, d):
    """T17 on the variant growth."""
    return series.trend_correlation(_gv(spark, d))


@register("trend_correlation", q("SELECT * FROM trend", TREND))
def trend_correlation(spark, d):
    """Correlation of variant growth with time per contract (>= 12 rates), classes <=.2/.4/.7.

    Registered with r, R^2 rounded to 6 decimals so that both engines agree bit for bit.
    """
    t = _trend(spark, d)
    return t.select("contractid", F.round("correlation", 6).alias("correlation"), "sensitivity_class",
                    F.round("r_squared", 6).alias("r_squared"), F.round("time_correlation", 6).alias("time_correlation"))


@register("top_trend", q("""
SELECT contractid, round(correlation, 6) AS correlation, sensitivity_class, round(r_squared, 6) AS r_squared
FROM (SELECT * FROM trend_raw ORDER BY correlation DESC, contractid LIMIT 5) t""", TREND))
def top_trend(spark, d):
    """The five contracts whose variant growth correlates most with time."""
    top = series.top_n(_trend(spark, d), "correlation", 5, ["contractid", "correlation", "sensitivity_class",
                                                            "r_squared"])
    return top.withColumns({c: F.round(c, 6) for c in ("correlation", "r_squared")})


@register("month_spine", q("""
SELECT CAST(m.year_month AS DATE) AS year_month, CAST(coalesce(c.observations, 0) AS BIGINT) AS observations,
       CAST(coalesce(c.contracts, 0) AS BIGINT) AS contracts
FROM (SELECT unnest(generate_series(min(date_trunc('month', date)), max(date_trunc('month', date)), INTERVAL 1 MONTH)) AS year_month
      FROM timeseries) m
LEFT JOIN (SELECT date_trunc('month', date) AS year_month, count(*) AS observations,
                  count(DISTINCT contractid) AS contracts FROM timeseries GROUP BY 1) c
  ON CAST(m.year_month AS DATE) = CAST(c.year_month AS DATE)"""))
def month_spine(spark, d):
    """Month spine from first to last series month with rows and contracts per month."""
    return series.month_spine(_ts(spark, d))


# ------------------------------------------------------------------ tenant queries

_CWC = CLASSIFIED + """,
cwc AS (SELECT c.contractid, c.customerid, c.mandantid, k.age, k.age_group
        FROM contracts c JOIN classified k ON c.customerid = k.customerid
        WHERE c.mandantid IS NOT NULL AND k.age IS NOT NULL)
"""


@register("tenant_distribution", q("""
SELECT mandantid, count(*) AS contract_count, round(100.0 * count(*) / sum(count(*)) OVER (), 1) AS percentage
FROM contracts WHERE mandantid IS NOT NULL GROUP BY mandantid"""))
def tenant_distribution(spark, d):
    """M1: contracts per tenant."""
    return tenant.tenant_distribution(fx.contracts(spark, d))


@register("tenant_age", q("""
SELECT mandantid, count(*) AS count, round(avg(age), 1) AS mean_age, round(median(age), 1) AS median_age,
       round(stddev_samp(age), 1) AS std_age, round(min(age), 1) AS min_age, round(max(age), 1) AS max_age
FROM cwc GROUP BY mandantid""", _CWC))
def tenant_age(spark, d):
    """M2: holder age statistics per tenant."""
    return tenant.tenant_age(fx.contracts(spark, d), _classified(spark, d))


@register("tenant_age_bands", q("""
SELECT mandantid, age_group, count(*) AS n,
       round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY mandantid), 1) AS percentage
FROM cwc WHERE age_group IS NOT NULL GROUP BY mandantid, age_group""", _CWC))
def tenant_age_bands(spark, d):
    """M3: band x tenant counts and % within tenant."""
    return tenant.tenant_age_bands(fx.contracts(spark, d), _classified(spark, d))


@register("tenant_values", q("""
SELECT c.mandantid, count(*) AS observations, count(DISTINCT t.contractid) AS contracts,
       round(avg(t.surrender_value), 2) AS mean_surrender_value,
       round(stddev_samp(t.surrender_value), 2) AS std_surrender_value,
       round(min(t.surrender_value), 2) AS min_surrender_value, round(max(t.surrender_value), 2) AS max_surrender_value,
       round(quantile_cont(t.surrender_value, 0.5), 2) AS median_surrender_value,
       round(quantile_cont(t.surrender_value, 0.25), 2) AS q25_surrender_value,
       round(quantile_cont(t.surrender_value, 0.75), 2) AS q75_surrender_value
FROM timeseries t JOIN contracts c ON t.contractid = c.contractid
WHERE c.mandantid IS NOT NULL AND t.surrender_value IS NOT NULL GROUP BY c.mandantid"""), headline=True)
def tenant_values(spark, d):
    """M4: surrender value statistics per tenant with exact median and quartiles."""
    return tenant.tenant_values(_ts(spark, d), fx.contracts(spark, d))


@register("tenant_volatility", q("""
SELECT c.mandantid, count(*) AS contracts, round(avg(v.volatility), 3) AS mean_volatility,
       round(stddev_samp(v.volatility), 3) AS std_volatility, round(min(v.volatility), 3) AS min_volatility,
       round(max(v.volatility), 3) AS max_volatility, round(avg(v.risk_adjusted_return), 3) AS mean_risk_adjusted_return,
       round(median(v.volatility), 3) AS median_volatility
FROM vol v JOIN contracts c ON v.contractid = c.contractid
WHERE c.mandantid IS NOT NULL AND v.volatility IS NOT NULL GROUP BY c.mandantid""", VOL))
def tenant_volatility(spark, d):
    """M5: volatility statistics per tenant."""
    return tenant.tenant_volatility(_vol(spark, d), fx.contracts(spark, d))


# ------------------------------------------------------------------ combined analyses

_ENR = CLASSIFIED + """,
enr AS (SELECT c.contractid, c.customerid, c.mandantid, k.age, k.age_group
        FROM contracts c JOIN classified k ON c.customerid = k.customerid
        WHERE c.mandantid IS NOT NULL AND k.age_group IS NOT NULL)
"""


def _enriched(spark, d):
    return insights.enriched_contracts(fx.contracts(spark, d), _classified(spark, d))


@register("enriched_contracts", q("SELECT * FROM enr", _ENR))
def enriched_contracts(spark, d):
    """Contracts with holder age and band."""
    return _enriched(spark, d)


@register("band_tenant_cross", q("""
SELECT mandantid, age_group, count(*) AS n,
       round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY mandantid), 1) AS percentage
FROM enr GROUP BY mandantid, age_group""", _ENR))
def band_tenant_cross(spark, d):
    """Band x tenant cross table."""
    return insights.band_tenant_cross(_enriched(spark, d))


@register("volatility_by_tenant_band", q("""
SELECT e.mandantid, e.age_group, count(*) AS contracts, round(avg(v.volatility), 3) AS mean_volatility
FROM vv v JOIN enr e ON v.contractid = e.contractid
GROUP BY e.mandantid, e.age_group HAVING count(*) >= 2""", VV + "," + _ENR))
def volatility_by_tenant_band(spark, d):
    """D3: mean variant volatility per tenant x band, cells with at least 2 contracts."""
    return insights.volatility_by_tenant_band(_vv(spark, d), _enriched(spark, d))


_SUMMARY_SQL = """
asum AS (SELECT age_group, count(*) AS count, round(avg(age), 1) AS mean_age FROM classified GROUP BY age_group),
tdist AS (SELECT mandantid, count(*) AS contract_count FROM contracts WHERE mandantid IS NOT NULL GROUP BY mandantid)
"""


@register("leaders", q("""
SELECT * FROM (
  SELECT 'age_group' AS dimension, CAST(age_group AS VARCHAR) AS leader, CAST(count AS BIGINT) AS count,
         round(100.0 * count / (SELECT sum(count) FROM asum), 1) AS percentage
  FROM asum ORDER BY count DESC,
       CASE age_group WHEN '<30' THEN 1 WHEN '30-50' THEN 2 WHEN '>50' THEN 3 END NULLS LAST LIMIT 1)
UNION ALL
SELECT * FROM (
  SELECT 'mandantid', mandantid, CAST(contract_count AS BIGINT),
         round(100.0 * contract_count / (SELECT sum(contract_count) FROM tdist), 1)
  FROM tdist ORDER BY contract_count DESC, mandantid LIMIT 1)""", CLASSIFIED + "," + _SUMMARY_SQL))
def leaders(spark, d):
    """Dominant age band and leading tenant."""
    a = age.create_age_summary(_classified(spark, d))
    t = tenant.tenant_distribution(fx.contracts(spark, d))
    band_order = label_rank("age_group", age.DEFAULT_LABELS).asc_nulls_last()
    return (insights.leader(a, "age_group", "count", "age_group", band_order)
            .unionByName(insights.leader(t, "mandantid", "contract_count", "mandantid")))


@register("weighted_age", q("""
SELECT round(sum(mean_age * count) / sum(count), 1) AS weighted_mean_age FROM asum""",
                            CLASSIFIED + "," + _SUMMARY_SQL))
def weighted_age(spark, d):
    """Mean age weighted by band counts."""
    return insights.weighted_mean_age(age.create_age_summary(_classified(spark, d)))


@register("risk_share", q("""
SELECT CAST(count_if(volatility_class IN ('Hoch', 'Sehr hoch')) AS BIGINT) AS high_volatility_contracts,
       count(*) AS contracts,
       round(100.0 * count_if(volatility_class IN ('Hoch', 'Sehr hoch')) / count(*), 1) AS high_volatility_percent,
       round(avg(volatility), 2) AS mean_volatility
FROM vv""", VV))
def risk_share(spark, d):
    """Share of high-volatility contracts (variant classes)."""
    return insights.risk_share(_vv(spark, d))


@register("sensitivity_share", q("""
SELECT CAST(count_if(sensitivity_class IN ('Hoch', 'Sehr hoch')) AS BIGINT) AS high_sensitivity_contracts,
       count(*) AS contracts,
       round(100.0 * count_if(sensitivity_class IN ('Hoch', 'Sehr hoch')) / count(*), 1) AS high_sensitivity_percent,
       round(avg(abs(correlation)), 3) AS mean_abs_correlation
FROM trend_raw""", TREND))
def sensitivity_share(spark, d):
    """Share of highly time-sensitive contracts (trend classes), mean |r|."""
    return insights.sensitivity_share(_trend(spark, d))


_TFA = """
tfa AS (SELECT * FROM timeseries WHERE contractid IS NOT NULL AND date IS NOT NULL AND surrender_value IS NOT NULL
        AND contractid <> '' AND surrender_value > 0)
"""


@register("coverage", q("""
SELECT (SELECT count(*) FROM contracts) AS contracts,
       (SELECT count(DISTINCT contractid) FROM tfa) AS contracts_with_series,
       (SELECT count(*) FROM customers) AS customers,
       (SELECT count(*) FROM customers WHERE birthdate IS NOT NULL) AS customers_with_age,
       round((SELECT count(*) FROM tfa) / (SELECT count(DISTINCT contractid) FROM tfa), 1)
         AS mean_observations_per_contract""", _TFA))
def coverage(spark, d):
    """Series coverage of contracts, age coverage of customers, observations per contract.

    The series is the analysis input: complete rows with a positive value (T1 + T15 filter).
    """
    tfa = series.series_input(_ts(spark, d), positive_only=True)
    return insights.coverage(fx.contracts(spark, d), fx.customers(spark, d), _classified(spark, d), tfa)
