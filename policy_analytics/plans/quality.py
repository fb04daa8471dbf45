"""Registered quality queries (Q2-Q21).

Per-table checks run on the reader-typed raw tables (standard names, dates and amounts
typed, nothing validated); referential checks run on the clean views.
"""

from __future__ import annotations

from functools import reduce

from ..operators import quality
from ..sources import fixtures as fx
from ..sources import io
from .cleaning import _date_iso_sql, _date_multi_sql
from .oracle import AS_OF, q
from .registry import register

TYPED_CTES = f"""
rc AS (SELECT contract_id AS contractid, customer_id AS customerid, mandant_id AS mandantid FROM raw_contracts),
rcu AS (SELECT customer_id AS customerid, {_date_multi_sql('dob')} AS birthdate FROM raw_customers),
rts AS (SELECT contract_id AS contractid, {_date_iso_sql('datum')} AS date,
               TRY_CAST(regexp_replace(rueckkaufswert, '[^0-9.-]', '', 'g') AS DOUBLE) AS surrender_value
        FROM raw_timeseries)
"""

# (frame, table, [(column, kind)]) with kind text / date / double
LAYOUT = [
    ("rc", "contracts", [("contractid", "text"), ("customerid", "text"), ("mandantid", "text")]),
    ("rcu", "customers", [("customerid", "text"), ("birthdate", "date")]),
    ("rts", "timeseries", [("contractid", "text"), ("date", "date"), ("surrender_value", "double")]),
]
ID_COLS = [("rc", "contracts", "contractid", "^V[0-9]+$", "V"),
           ("rc", "contracts", "customerid", "^K[0-9]+$", "K"),
           ("rcu", "customers", "customerid", "^K[0-9]+$", "K"),
           ("rts", "timeseries", "contractid", "^V[0-9]+$", "V")]


def _miss_sql(col, kind):
    if kind == "text":
        return f"({col} IS NULL OR {col} IN ('', 'NULL', 'null'))"
    if kind == "double":
        return f"({col} IS NULL OR isnan({col}))"
    return f"({col} IS NULL)"


def _typed(spark, d):
    return {n: io.typed_raw(fx.RAW_VIEWS[n](spark, d), n) for n in ("contracts", "customers", "timeseries")}


def _clean(spark, d):
    return fx.contracts(spark, d), fx.customers(spark, d), fx.timeseries(spark, d)


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


_MISSING_SQL = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS \"column\", CAST(count_if({_miss_sql(c, k)}) AS BIGINT) AS missing, "
    f"round(100.0 * count_if({_miss_sql(c, k)}) / count(*), 1) AS missing_percent FROM {f}"
    for f, t, cols in LAYOUT for c, k in cols)


@register("missing_profile", q(_MISSING_SQL, TYPED_CTES))
def missing_profile(spark, d):
    """Q2: missing values per column of the three raw tables."""
    return _union([quality.missing_profile(df, n) for n, df in _typed(spark, d).items()])


def _dup_sql(f, t, has_id):
    ids = (f"CAST(count(*) - count(DISTINCT contractid) - CASE WHEN count_if(contractid IS NULL) > 0 THEN 1 ELSE 0 END "
           f"AS BIGINT) AS duplicate_ids, "
           f"(SELECT string_agg(x, ', ' ORDER BY x) FROM (SELECT contractid AS x FROM {f} WHERE contractid IS NOT NULL "
           f"GROUP BY contractid HAVING count(*) > 1 ORDER BY contractid LIMIT 3) e) AS duplicate_id_examples"
           if has_id else "CAST(NULL AS BIGINT) AS duplicate_ids, CAST(NULL AS VARCHAR) AS duplicate_id_examples")
    return (f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS rows, "
            f"CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {f}) z) AS BIGINT) AS duplicate_rows, "
            f"{ids} FROM {f}")


@register("duplicate_profile", q(" UNION ALL ".join([
    _dup_sql("rc", "contracts", True), _dup_sql("rcu", "customers", False), _dup_sql("rts", "timeseries", True)]),
    TYPED_CTES))
def duplicate_profile(spark, d):
    """Q3/Q4: duplicate rows and repeated contract ids with examples."""
    return _union([quality.duplicate_profile(df, n, "contractid") for n, df in _typed(spark, d).items()])


def _id_sql(f, t, c, pat, letter, what):
    non_empty = f"({c} IS NOT NULL AND {c} <> '')"
    valid = f"({non_empty} AND regexp_matches({c}, '{pat}'))"
    invalid = f"({non_empty} AND NOT regexp_matches({c}, '{pat}'))"
    head = f"SELECT '{t}' AS table_name, '{c}' AS \"column\", "
    if what == "format":
        return head + (
            f"CAST(count(*) AS BIGINT) AS total, CAST(count_if({non_empty}) AS BIGINT) AS non_empty, "
            f"CAST(count_if({valid}) AS BIGINT) AS valid, CAST(count_if({invalid}) AS BIGINT) AS invalid, "
            f"CAST(count_if(NOT {non_empty}) AS BIGINT) AS missing, "
            f"CAST(count({c}) - count(DISTINCT {c}) AS BIGINT) AS duplicates, "
            f"CAST(CASE WHEN count_if({non_empty}) = 0 THEN 1 ELSE 0 END AS BIGINT) AS all_missing_issue, "
            f"(SELECT string_agg(x, ', ' ORDER BY x) FROM (SELECT {c} AS x FROM {f} WHERE {invalid} "
            f"ORDER BY {c} LIMIT 5) e) AS invalid_examples FROM {f}")
    if what == "defects":
        return head + (
            f"coalesce(bool_or({invalid} AND contains({c}, '^')), false) AS has_caret, "
            f"coalesce(bool_or({invalid} AND contains({c}, '(')), false) AS has_paren, "
            f"coalesce(bool_or({invalid} AND contains({c}, ' ')), false) AS has_space FROM {f}")
    num = f"TRY_CAST(substr({c}, 2) AS DOUBLE)"
    return head + (
        f"CASE WHEN min(CASE WHEN {valid} THEN {num} END) IS NOT NULL "
        f"THEN printf('{letter}%03.0f', min(CASE WHEN {valid} THEN {num} END)) END AS min_id, "
        f"CASE WHEN max(CASE WHEN {valid} THEN {num} END) IS NOT NULL "
        f"THEN printf('{letter}%03.0f', max(CASE WHEN {valid} THEN {num} END)) END AS max_id FROM {f}")


def _id_profiles(spark, d):
    t = _typed(spark, d)
    return _union([quality.id_format_profile(t[n], n, c) for _, n, c, _, _ in ID_COLS])


@register("id_format_profile", q(" UNION ALL ".join(_id_sql(*x, "format") for x in ID_COLS), TYPED_CTES))
def id_format_profile(spark, d):
    """Q5/Q8/Q9: id format checks and id summary per id column."""
    return _id_profiles(spark, d).select("table_name", "column", "total", "non_empty", "valid", "invalid",
                                         "missing", "duplicates", "all_missing_issue", "invalid_examples")


@register("id_defect_classes", q(" UNION ALL ".join(_id_sql(*x, "defects") for x in ID_COLS), TYPED_CTES))
def id_defect_classes(spark, d):
    """Q6: which defect classes the invalid ids show."""
    return _id_profiles(spark, d).select("table_name", "column", "has_caret", "has_paren", "has_space")


@register("id_range", q(" UNION ALL ".join(_id_sql(*x, "range") for x in ID_COLS), TYPED_CTES))
def id_range(spark, d):
    """Q7: numeric range of the valid ids, shown as letter + 3-digit number."""
    return _id_profiles(spark, d).select("table_name", "column", "min_id", "max_id")


@register("birthdate_checks", q(f"""
SELECT 'customers' AS table_name, CAST(count_if(birthdate > {AS_OF}) AS BIGINT) AS future_births,
       CAST(count_if(birthdate < DATE '1900-01-01') AS BIGINT) AS births_before_1900,
       CAST(count_if(birthdate IS NULL) AS BIGINT) AS missing_birthdates FROM rcu""", TYPED_CTES))
def birthdate_checks(spark, d):
    """Q10: future births and births before 1900."""
    return quality.birthdate_checks(_typed(spark, d)["customers"], "customers", fx.AS_OF)


@register("age_stats", q(f"""
SELECT count(v) AS customers, round(min(v), 1) AS youngest, round(max(v), 1) AS oldest,
       round(avg(v), 1) AS mean_age, round(median(v), 1) AS median_age
FROM (SELECT CASE WHEN a BETWEEN 0 AND 120 THEN a END AS v
      FROM (SELECT date_diff('day', birthdate, {AS_OF}) / 365.25 AS a FROM rcu) t) u""", TYPED_CTES))
def age_stats(spark, d):
    """Q11: age statistics over ages within [0, 120]."""
    return quality.age_stats(_typed(spark, d)["customers"], fx.AS_OF)


@register("tenant_domain", q("""
SELECT 'contracts' AS table_name, mandantid AS unexpected_value, count(*) AS rows FROM rc
WHERE mandantid IS NOT NULL AND mandantid NOT IN ('LV1', 'LV2') GROUP BY mandantid""", TYPED_CTES))
def tenant_domain(spark, d):
    """Q12: unexpected tenant values."""
    return quality.tenant_domain(_typed(spark, d)["contracts"], "contracts")


@register("tenant_frequency", q("""
SELECT mandantid, count(*) AS rows FROM rc WHERE mandantid IS NOT NULL GROUP BY mandantid""", TYPED_CTES))
def tenant_frequency(spark, d):
    """Q13: rows per raw tenant value."""
    return quality.tenant_frequency(_typed(spark, d)["contracts"])


@register("numeric_profile", q("""
SELECT 'timeseries' AS table_name, 'surrender_value' AS "column", count(surrender_value) AS non_null,
       CAST(count_if(surrender_value < 0) AS BIGINT) AS negatives, round(min(surrender_value), 2) AS min_value,
       round(max(surrender_value), 2) AS max_value, round(avg(surrender_value), 2) AS mean_value FROM rts""",
                               TYPED_CTES))
def numeric_profile(spark, d):
    """Q14/Q15: range, mean and negatives of numeric columns."""
    return _union([quality.numeric_profile(df, n) for n, df in _typed(spark, d).items()])


# ------------------------------------------------------------------ referential

REF_CTES = """
ck AS (SELECT DISTINCT contractid FROM contracts WHERE contractid IS NOT NULL),
uk AS (SELECT DISTINCT customerid FROM customers WHERE customerid IS NOT NULL),
tk AS (SELECT DISTINCT contractid FROM timeseries WHERE contractid IS NOT NULL),
cust_ok AS (SELECT DISTINCT c.contractid FROM contracts c WHERE c.contractid IS NOT NULL
            AND c.customerid IN (SELECT customerid FROM uk)),
cov AS (
  SELECT 'contracts_to_customers' AS relation, (SELECT count(*) FROM ck) AS contracts,
         (SELECT count(*) FROM cust_ok) AS matched
  UNION ALL
  SELECT 'contracts_to_timeseries', (SELECT count(*) FROM ck),
         (SELECT count(*) FROM ck WHERE contractid IN (SELECT contractid FROM tk))),
coverage_t AS (SELECT relation, contracts, matched, contracts - matched AS missing,
                      round(100.0 * matched / contracts, 1) AS coverage_percent FROM cov)
"""


@register("key_counts", q("""
SELECT 'contracts' AS table_name, (SELECT count(*) FROM ck) AS distinct_keys
UNION ALL SELECT 'customers', (SELECT count(*) FROM uk)
UNION ALL SELECT 'timeseries', (SELECT count(*) FROM tk)""", REF_CTES))
def key_counts(spark, d):
    """Q16: distinct keys per table."""
    return quality.key_counts(*_clean(spark, d))


@register("key_coverage", q("SELECT * FROM coverage_t", REF_CTES), headline=True)
def key_coverage(spark, d):
    """Q17: coverage of contracts by customers and by series."""
    return quality.key_coverage(*_clean(spark, d))


@register("missing_customers", q("""
SELECT DISTINCT contractid, customerid FROM contracts
WHERE contractid IS NOT NULL AND (customerid IS NULL OR customerid NOT IN (SELECT customerid FROM uk))""", REF_CTES))
def missing_customers(spark, d):
    """Q18: contracts whose customer is missing."""
    c, u, _ = _clean(spark, d)
    return quality.missing_customers(c, u)


@register("missing_series", q("""
SELECT contractid FROM ck WHERE contractid NOT IN (SELECT contractid FROM tk)""", REF_CTES))
def missing_series(spark, d):
    """Q18: contracts without a series."""
    c, _, t = _clean(spark, d)
    return quality.missing_series(c, t)


@register("orphan_keys", q("""
SELECT 'customers_without_contract' AS kind, count(*) AS orphans,
       (SELECT string_agg(x, ', ' ORDER BY x) FROM (SELECT customerid AS x FROM o1 ORDER BY customerid LIMIT 3) e) AS examples
FROM o1
UNION ALL
SELECT 'timeseries_without_contract', count(*),
       (SELECT string_agg(x, ', ' ORDER BY x) FROM (SELECT contractid AS x FROM o2 ORDER BY contractid LIMIT 3) e)
FROM o2""", REF_CTES + """,
o1 AS (SELECT customerid FROM uk WHERE customerid NOT IN
       (SELECT customerid FROM contracts WHERE customerid IS NOT NULL)),
o2 AS (SELECT contractid FROM tk WHERE contractid NOT IN (SELECT contractid FROM ck))"""))
def orphan_keys(spark, d):
    """Q19: orphan customers and orphan series keys with examples."""
    return quality.orphan_keys(*_clean(spark, d))


def _issue_sql():
    miss = {t: " + ".join(f"count_if({_miss_sql(c, k)})" for c, k in cols) for f, t, cols in LAYOUT}

    def dup_rows(f):
        return f"(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {f}) z))"

    def dup_ids():
        return "(count(*) - count(DISTINCT contractid) - CASE WHEN count_if(contractid IS NULL) > 0 THEN 1 ELSE 0 END)"

    def invalid(c, pat):
        return f"count_if({c} IS NOT NULL AND {c} <> '' AND NOT regexp_matches({c}, '{pat}'))"

    def all_missing(c):
        return f"CASE WHEN count_if({c} IS NOT NULL AND {c} <> '') = 0 THEN 1 ELSE 0 END"

    contracts = (f"SELECT 'contracts' AS table_name, CAST({miss['contracts']} + {dup_rows('rc')} + {dup_ids()} AS BIGINT) AS b, "
                 f"CAST({invalid('contractid', '^V[0-9]+$')} + {all_missing('contractid')} + "
                 f"{invalid('customerid', '^K[0-9]+$')} + "
                 f"(SELECT count(DISTINCT mandantid) FROM rc WHERE mandantid NOT IN ('LV1', 'LV2')) AS BIGINT) AS z FROM rc")
    customers = (f"SELECT 'customers', CAST({miss['customers']} + {dup_rows('rcu')} AS BIGINT), "
                 f"CAST({invalid('customerid', '^K[0-9]+$')} + count_if(birthdate > {AS_OF}) + "
                 f"count_if(birthdate < DATE '1900-01-01') AS BIGINT) FROM rcu")
    series = (f"SELECT 'timeseries', CAST({miss['timeseries']} + {dup_rows('rts')} + {dup_ids()} AS BIGINT), "
              f"CAST({invalid('contractid', '^V[0-9]+$')} + {all_missing('contractid')} + "
              f"count_if(surrender_value < 0) AS BIGINT) FROM rts")
    ref = "SELECT 'referential_integrity', CAST(0 AS BIGINT), CAST(sum(missing) AS BIGINT) FROM coverage_t"
    return (f"SELECT table_name, b AS basic_issues, z AS business_issues, CAST(b + z AS BIGINT) AS issues_found "
            f"FROM ({contracts} UNION ALL {customers} UNION ALL {series} UNION ALL {ref}) s")


@register("quality_summary", q(_issue_sql(), TYPED_CTES + "," + REF_CTES))
def quality_summary(spark, d):
    """Q20/Q21: basic, business and total issues per table, and referential issues."""
    c, u, t = _clean(spark, d)
    return quality.quality_summary(_typed(spark, d), {"contracts": c, "customers": u, "timeseries": t}, fx.AS_OF)


@register("quality_total", q(f"SELECT 'total' AS table_name, CAST(sum(issues_found) AS BIGINT) AS total_issues FROM ({_issue_sql()}) g",
                             TYPED_CTES + "," + REF_CTES))
def quality_total(spark, d):
    """Q20: the grand total of issues over all tables and the referential checks."""
    return quality.total_issues(quality_summary(spark, d))
