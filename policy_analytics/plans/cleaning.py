"""Registered cleaning queries (C1-C16) on the dirty fixture views."""

from __future__ import annotations

from functools import reduce

from ..operators import clean
from ..sources import fixtures as fx
from .oracle import AS_OF, q
from .registry import register


def _id_sql(col: str, letter: str) -> str:
    inner = f"regexp_replace(regexp_replace({col}, '[^{letter}0-9]', '', 'g'), '^{letter}0*', '{letter}')"
    return f"CASE WHEN length({inner}) >= 2 THEN {inner} END"


def _tenant_sql(col: str) -> str:
    u = f"upper(regexp_replace({col}, '[^LV12]', '', 'g'))"
    return f"CASE WHEN regexp_matches({u}, 'LV.*1') THEN 'LV1' WHEN regexp_matches({u}, 'LV.*2') THEN 'LV2' END"


def _date_multi_sql(col: str) -> str:
    s = f"trim({col})"
    iso = f"regexp_extract({s}, '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}', 0)"
    return (f"coalesce(CAST(try_strptime({iso}, '%Y-%m-%d') AS DATE), CAST(try_strptime({s}, '%Y/%m/%d') AS DATE), "
            f"CAST(try_strptime({s}, '%d.%m.%Y') AS DATE), CAST(try_strptime({s}, '%d/%m/%Y') AS DATE))")


def _date_iso_sql(col: str) -> str:
    iso = f"regexp_extract(trim({col}), '^[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}', 0)"
    return f"CAST(try_strptime({iso}, '%Y-%m-%d') AS DATE)"


CLEAN_CTES = f"""
cc AS (SELECT contract_id, customer_id, mandant_id,
              {_id_sql('contract_id', 'V')} AS contractid, {_id_sql('customer_id', 'K')} AS customerid,
              {_tenant_sql('mandant_id')} AS mandantid
       FROM raw_contracts),
cc_kept AS (SELECT contractid, customerid, mandantid FROM cc WHERE contractid IS NOT NULL),
cc_mode AS (SELECT mandantid AS m FROM cc_kept WHERE mandantid IS NOT NULL
            GROUP BY mandantid ORDER BY count(*) DESC, mandantid LIMIT 1),
cc_clean AS (SELECT DISTINCT contractid, customerid, coalesce(mandantid, (SELECT m FROM cc_mode)) AS mandantid FROM cc_kept),
cu AS (SELECT customer_id, {_id_sql('customer_id', 'K')} AS customerid, d AS parsed,
              CASE WHEN d BETWEEN DATE '1900-01-01' AND {AS_OF} THEN d END AS birthdate
       FROM (SELECT customer_id, {_date_multi_sql('dob')} AS d FROM raw_customers) t),
cu_clean AS (SELECT DISTINCT customerid, birthdate FROM cu WHERE customerid IS NOT NULL),
ts AS (SELECT contract_id, {_id_sql('contract_id', 'V')} AS contractid, d AS parsed, v AS parsed_value,
              CASE WHEN d BETWEEN DATE '1990-01-01' AND {AS_OF} THEN d END AS date,
              CASE WHEN v >= 0 THEN v END AS surrender_value
       FROM (SELECT contract_id, {_date_iso_sql('datum')} AS d,
                    TRY_CAST(regexp_replace(rueckkaufswert, '[^0-9.-]', '', 'g') AS DOUBLE) AS v
             FROM raw_timeseries) t),
ts_clean AS (SELECT DISTINCT contractid, date, surrender_value FROM ts WHERE contractid IS NOT NULL AND date IS NOT NULL),
audit AS (
  SELECT 'contracts' AS table_type, CAST(count(*) AS BIGINT) AS original_rows, CAST(3 AS BIGINT) AS original_cols,
         (SELECT CAST(count(*) AS BIGINT) FROM cc_clean) AS final_rows, CAST(3 AS BIGINT) AS final_cols,
         CAST(count_if(contractid IS NULL) AS BIGINT) AS null_key_rows,
         CAST(CASE WHEN count_if(contractid IS NOT NULL AND mandantid IS NOT NULL) > 0
                   THEN count_if(contractid IS NOT NULL AND mandantid IS NULL) ELSE 0 END AS BIGINT) AS imputed_values
  FROM cc
  UNION ALL
  SELECT 'customers', count(*), 2, (SELECT count(*) FROM cu_clean), 2, count_if(customerid IS NULL), 0 FROM cu
  UNION ALL
  SELECT 'timeseries', count(*), 3, (SELECT count(*) FROM ts_clean), 3,
         count_if(contractid IS NULL OR date IS NULL), 0 FROM ts),
audit_full AS (
  SELECT table_type, original_rows, original_cols, final_rows, final_cols,
         CAST(original_rows - final_rows AS BIGINT) AS dropped_rows, imputed_values,
         round(100.0 * final_rows / original_rows, 1) AS rows_retained_percent,
         CAST(null_key_rows AS BIGINT) AS null_key_rows,
         CAST(original_rows - null_key_rows - final_rows AS BIGINT) AS duplicates_removed
  FROM audit)
"""


def _cleaned(spark, sf_dir, name):
    return clean.clean_table(fx.RAW_VIEWS[name](spark, sf_dir), name, fx.AS_OF)


def _audit(spark, sf_dir):
    cols = clean.LOG_SCHEMA.fieldNames() + ["null_key_rows", "duplicates_removed"]
    logs = [_cleaned(spark, sf_dir, n).log.select(*cols) for n in ("contracts", "customers", "timeseries")]
    return reduce(lambda a, b: a.unionByName(b), logs)


@register("clean_contracts", q("SELECT * FROM cc_clean", CLEAN_CTES))
def clean_contracts(spark, sf_dir):
    """Contract ids, customer ids, tenants; drop, impute mode, dedupe."""
    return _cleaned(spark, sf_dir, "contracts").data


@register("clean_customers", q("SELECT * FROM cu_clean", CLEAN_CTES))
def clean_customers(spark, sf_dir):
    """Customer ids and three-format birth dates."""
    return _cleaned(spark, sf_dir, "customers").data


@register("clean_timeseries", q("SELECT * FROM ts_clean", CLEAN_CTES))
def clean_timeseries(spark, sf_dir):
    """Series ids, ISO dates, amounts."""
    return _cleaned(spark, sf_dir, "timeseries").data


@register("cleaning_audit", q("SELECT * FROM audit_full", CLEAN_CTES))
def cleaning_audit(spark, sf_dir):
    """One audit row per cleaned table."""
    return _audit(spark, sf_dir)


@register("pipeline_totals", q("""
SELECT table_type, original_rows, final_rows, CAST(original_rows - final_rows AS BIGINT) AS removed_rows,
       rows_retained_percent FROM audit_full
UNION ALL
SELECT 'total', CAST(sum(original_rows) AS BIGINT), CAST(sum(final_rows) AS BIGINT),
       CAST(sum(original_rows) - sum(final_rows) AS BIGINT), round(100.0 * sum(final_rows) / sum(original_rows), 1)
FROM audit_full""", CLEAN_CTES))
def pipeline_totals(spark, sf_dir):
    """Rows in and out per table and overall, retention %."""
    return clean.pipeline_totals(_audit(spark, sf_dir))


def _fix_sql(table, frame, raw, col, pattern):
    if pattern is None:
        bad_raw = f"{raw} NOT IN ('LV1', 'LV2')"
        bad_new = f"{col} NOT IN ('LV1', 'LV2')"
    else:
        bad_raw = f"NOT regexp_matches({raw}, '{pattern}')"
        bad_new = f"NOT regexp_matches({col}, '{pattern}')"
    return (f"SELECT '{table}' AS table_type, '{col}' AS \"column\", "
            f"CAST(count_if({raw} IS NOT NULL AND {bad_raw}) AS BIGINT) AS invalid_before, "
            f"CAST(count_if({col} IS NOT NULL AND {bad_new}) AS BIGINT) AS invalid_after FROM {frame}")


_FIX_BODY = " UNION ALL ".join([
    _fix_sql("contracts", "cc", "contract_id", "contractid", "^V[0-9]+$"),
    _fix_sql("contracts", "cc", "customer_id", "customerid", "^K[0-9]+$"),
    _fix_sql("contracts", "cc", "mandant_id", "mandantid", None),
    _fix_sql("customers", "cu", "customer_id", "customerid", "^K[0-9]+$"),
    _fix_sql("timeseries", "ts", "contract_id", "contractid", "^V[0-9]+$"),
])


@register("format_fixes", q(f"""
SELECT table_type, "column", invalid_before, invalid_after, CAST(invalid_before - invalid_after AS BIGINT) AS fixed
FROM ({_FIX_BODY}) f""", CLEAN_CTES))
def format_fixes(spark, sf_dir):
    """Formatting issues fixed per id column."""
    parts = [clean.format_fixes(_cleaned(spark, sf_dir, n).log) for n in ("contracts", "customers", "timeseries")]
    return reduce(lambda a, b: a.unionByName(b), parts)
