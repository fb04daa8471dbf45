"""Independent DuckDB SQL for every registered query (the correctness oracle).

The fixture views of :mod:`policy_analytics.sources.fixtures` are repeated here as
CTEs over the pre-registered base tables, so the oracle shares no code with Spark.
"""

from __future__ import annotations

AS_OF = "DATE '2024-12-31'"

# lineitem rows that the ``timeseries`` view leaves out, so that some contracts have no series
SERIES_CUT = " WHERE l_partkey % 19 <> 7"

FIXTURE_CTES = f"""
contracts AS (
  SELECT concat('V', CAST(p_partkey AS VARCHAR)) AS contractid,
         CASE WHEN p_partkey % 23 = 5 THEN NULL
              WHEN p_partkey % 31 = 9 THEN concat('K', CAST(p_partkey + 100000000 AS VARCHAR))
              ELSE concat('K', CAST(p_partkey * 3 // 4 AS VARCHAR)) END AS customerid,
         CASE WHEN p_size % 3 = 0 THEN 'LV2' ELSE 'LV1' END AS mandantid
  FROM part),
customers AS (
  SELECT concat('K', CAST(c_custkey AS VARCHAR)) AS customerid,
         CASE WHEN c_custkey % 17 = 0 THEN NULL
              ELSE CAST(DATE '1930-01-01' + CAST((c_custkey * 7919) % 27000 AS INTEGER) AS DATE) END AS birthdate
  FROM customer),
timeseries AS (
  SELECT concat('V', CAST(l_partkey + CASE WHEN l_partkey % 29 = 3 THEN 100000000 ELSE 0 END AS VARCHAR)) AS contractid,
         CAST(l_shipdate AS DATE) AS date,
         CASE WHEN l_linenumber = 7 AND l_quantity < 5 THEN NULL
              ELSE 10000 + 4 * date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) + 2 * l_quantity
         END AS surrender_value
  FROM lineitem{SERIES_CUT}),
daily_rates AS (
  SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) / 100000 - 1 AS interest_rate
  FROM orders GROUP BY CAST(o_orderdate AS DATE)),
raw_contracts AS (
  WITH p AS (SELECT *, CAST(p_partkey AS VARCHAR) AS k FROM part)
  SELECT CASE WHEN p_partkey % 44 = 4 THEN NULL
              WHEN p_partkey % 11 = 0 THEN concat(' V-00', k)
              WHEN p_partkey % 11 = 1 THEN concat('V0', k, '^')
              WHEN p_partkey % 11 = 2 THEN concat('(V', k, ')')
              WHEN p_partkey % 11 = 3 THEN concat('v', k)
              ELSE concat('V', k) END AS contract_id,
         concat(CASE WHEN p_partkey % 13 = 0 THEN 'K00' ELSE 'K' END, CAST(p_partkey % 1200 AS VARCHAR)) AS customer_id,
         CASE p_size % 7 WHEN 0 THEN 'LV 1' WHEN 1 THEN 'LV2' WHEN 2 THEN 'lv1' WHEN 3 THEN NULL
                         WHEN 4 THEN 'LV-2' WHEN 5 THEN 'LV21' ELSE 'LV1' END AS mandant_id
  FROM p
  UNION ALL
  SELECT concat('V', k), concat('K', CAST(p_partkey % 1200 AS VARCHAR)), 'LV1' FROM p WHERE p_partkey % 50 = 6),
raw_customers AS (
  WITH b AS (SELECT c_custkey, CAST(DATE '1890-01-01' + CAST((c_custkey * 7919) % 51000 AS INTEGER) AS DATE) AS d FROM customer),
       e AS (SELECT c_custkey, CAST(year(d) AS VARCHAR) AS y, lpad(CAST(month(d) AS VARCHAR), 2, '0') AS m,
                    lpad(CAST(day(d) AS VARCHAR), 2, '0') AS dd FROM b)
  SELECT CASE WHEN c_custkey % 97 = 0 THEN ''
              ELSE concat(CASE WHEN c_custkey % 10 = 0 THEN 'K-0' ELSE 'K' END, CAST(c_custkey AS VARCHAR)) END AS customer_id,
         CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 17 = 1 THEN 'NULL'
              WHEN c_custkey % 3 = 0 THEN concat(dd, '.', m, '.', y)
              WHEN c_custkey % 3 = 1 THEN concat(dd, '/', m, '/', y)
              ELSE concat(y, '-', m, '-', dd) END AS dob
  FROM e),
raw_timeseries AS (
  SELECT CASE WHEN l_linenumber = 7 AND l_quantity < 3 THEN NULL ELSE concat('V', CAST(l_partkey AS VARCHAR)) END AS contract_id,
         CASE WHEN l_linenumber = 6 AND l_quantity < 3 THEN '1985-01-01' ELSE CAST(CAST(l_shipdate AS DATE) AS VARCHAR) END AS datum,
         CASE WHEN l_linenumber = 5 AND l_quantity < 3 THEN 'n/a'
              WHEN l_linenumber = 4 AND l_quantity < 3 THEN '-1.00'
              ELSE concat('EUR ', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)) END AS rueckkaufswert
  FROM lineitem)
"""


def q(body: str, ctes: str = "", whole_series: bool = False) -> str:
    """Fixture CTEs (``whole_series``: the series of every lineitem row), optional extra CTEs, then the query body."""
    fixtures = FIXTURE_CTES.replace(SERIES_CUT, "") if whole_series else FIXTURE_CTES
    extra = f",\n{ctes.strip().rstrip(',')}" if ctes.strip() else ""
    return f"WITH {fixtures.strip()}{extra}\n{body.strip()}"


def age_band_case(col: str, breaks, labels) -> str:
    """Left-closed band CASE over ``[0, b1), ..., [bk, inf)``."""
    edges = [0, *breaks]
    parts = []
    for i, lab in enumerate(labels):
        lo = edges[i]
        cond = f"{col} >= {lo}"
        if i + 1 < len(edges):
            cond += f" AND {col} < {edges[i + 1]}"
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


AGE = f"round(date_diff('day', birthdate, {AS_OF}) / 365.25, 1)"

CLASSIFIED = f"""
classified AS (
  SELECT customerid, birthdate, age, {age_band_case('age', (30, 50), ('<30', '30-50', '>50'))} AS age_group
  FROM (SELECT customerid, birthdate, {AGE} AS age FROM customers WHERE birthdate IS NOT NULL) t)
"""
