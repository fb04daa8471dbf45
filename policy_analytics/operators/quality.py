"""Quality profiling of the internal tables (Q1-Q21).

Scalar checks of a table are fused into one aggregate; duplicate checks are grouped
counts (partial aggregation, so a repeated key is combined map-side); referential
checks are bit arithmetic on key sets (:mod:`.keysets`). Example lists are ``orderBy + limit``
(top-k per partition, never a full gather).
"""

from __future__ import annotations

import datetime as dt
import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules
from ..functions.stats import one_row, rnd
from . import keysets

# Column-name pattern of value columns checked for negatives, the id
# patterns per id column, number of examples shown, and the age window of the stats.
VALUE_NAME_PATTERN = re.compile("wert|value|amount", re.IGNORECASE)
ID_PATTERNS = {"contractid": rules.CONTRACT_ID_PATTERN, "customerid": rules.CUSTOMER_ID_PATTERN}
DUPLICATE_EXAMPLES = 3
INVALID_EXAMPLES = 5
AGE_WINDOW = (0.0, 120.0)


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def _examples(col: str, alias: str) -> Column:
    """Sorted examples joined by ", " (input is already limited); NULL when there are none."""
    lst = F.array_sort(F.collect_list(col))
    return F.when(F.size(lst) > 0, F.array_join(lst, ", ")).alias(alias)


def _missing(df: DataFrame, c: str) -> Column:
    t = df.schema[c].dataType
    if isinstance(t, T.StringType):
        return rules.is_missing_text(c)
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return F.col(c).isNull() | F.isnan(c)
    return F.col(c).isNull()


def basic_profile(df: DataFrame, table: str) -> DataFrame:
    """Q1: rows, columns, names and types (names and types are plan-time values)."""
    return df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(table).alias("table_name"), "rows",
        F.lit(len(df.columns)).cast("long").alias("columns"),
        F.lit(", ".join(df.columns)).alias("column_names"),
        F.lit(", ".join(t for _, t in df.dtypes)).alias("column_types"))


def missing_profile(df: DataFrame, table: str, digits: int | None = 1) -> DataFrame:
    """Q2: missing (NULL, "", "NULL", "null") per column with %, one aggregate + unpivot."""
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(_missing(df, c)).cast("long").alias(c) for c in df.columns])
    long = wide.unpivot("__rows", df.columns, "column", "missing")
    return long.select(F.lit(table).alias("table_name"), "column", "missing",
                       rnd(F.try_divide(100.0 * F.col("missing"), F.col("__rows")), digits).alias("missing_percent"))


def duplicate_profile(df: DataFrame, table: str, id_col: str | None = "contractid") -> DataFrame:
    """Q3/Q4: duplicate rows (rows - distinct rows), repeated ids (NULL counts), id examples."""
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).agg(
        F.sum("_n").cast("long").alias("rows"), F.sum(F.col("_n") - 1).cast("long").alias("duplicate_rows"))
    if id_col is None or id_col not in df.columns:
        return rows.select(F.lit(table).alias("table_name"), "rows", "duplicate_rows",
                           F.lit(None).cast("long").alias("duplicate_ids"),
                           F.lit(None).cast("string").alias("duplicate_id_examples"))
    ids = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"))
    dup = ids.agg(F.sum(F.col("_n") - 1).cast("long").alias("duplicate_ids"))
    ex = (ids.where((F.col("_n") > 1) & F.col(id_col).isNotNull()).select(id_col)
          .orderBy(id_col).limit(DUPLICATE_EXAMPLES)
          .agg(_examples(id_col, "duplicate_id_examples")))
    return one_row(rows, dup, ex).select(
        F.lit(table).alias("table_name"), "rows", "duplicate_rows", "duplicate_ids", "duplicate_id_examples")


def id_format_profile(df: DataFrame, table: str, col: str) -> DataFrame:
    """Q5-Q9: id format check on non-empty ids, defect classes, valid range, id summary."""
    pattern = ID_PATTERNS[col]
    letter = pattern[1]
    c = F.col(col).cast("string")
    non_empty = c.isNotNull() & (c != "")
    valid = non_empty & c.rlike(pattern)
    invalid = non_empty & ~c.rlike(pattern)
    num = F.substring(c, 2, 1 << 30).try_cast("double")
    agg = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(non_empty).cast("long").alias("non_empty"),
        F.count_if(valid).cast("long").alias("valid"),
        F.count_if(invalid).cast("long").alias("invalid"),
        F.count_if(~non_empty).cast("long").alias("missing"),
        F.coalesce(F.bool_or(invalid & c.contains("^")), F.lit(False)).alias("has_caret"),
        F.coalesce(F.bool_or(invalid & c.contains("(")), F.lit(False)).alias("has_paren"),
        F.coalesce(F.bool_or(invalid & c.contains(" ")), F.lit(False)).alias("has_space"),
        F.min(F.when(valid, num)).alias("_lo"),
        F.max(F.when(valid, num)).alias("_hi"),
    )
    dups = (df.where(c.isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates")))
    ex = (df.where(invalid).select(c.alias("_id")).orderBy("_id").limit(INVALID_EXAMPLES)
          .agg(_examples("_id", "invalid_examples")))
    return one_row(agg, dups, ex).select(
        F.lit(table).alias("table_name"), F.lit(col).alias("column"),
        "total", "non_empty", "valid", "invalid", "missing", "duplicates",
        F.when(F.col("non_empty") == 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("all_missing_issue"),
        "has_caret", "has_paren", "has_space",
        F.when(F.col("_lo").isNotNull(), F.format_string(f"{letter}%03.0f", F.col("_lo"))).alias("min_id"),
        F.when(F.col("_hi").isNotNull(), F.format_string(f"{letter}%03.0f", F.col("_hi"))).alias("max_id"),
        "invalid_examples")


def birthdate_checks(df: DataFrame, table: str, as_of: dt.date) -> DataFrame:
    """Q10: births after ``as_of`` and before 1900-01-01."""
    b = F.col("birthdate")
    return df.agg(
        F.lit(table).alias("table_name"),
        F.count_if(b > F.lit(as_of)).cast("long").alias("future_births"),
        F.count_if(b < F.lit(rules.MIN_BIRTHDATE)).cast("long").alias("births_before_1900"),
        F.count_if(b.isNull()).cast("long").alias("missing_birthdates"))


def age_stats(df: DataFrame, as_of: dt.date, digits: int | None = 1) -> DataFrame:
    """Q11: min / max / mean / median of unrounded ages within [0, 120].

    Ages come from day counts, a bounded domain, so the exact ``median`` stays small.
    """
    a = F.datediff(F.lit(as_of), F.col("birthdate")) / 365.25
    lo, hi = AGE_WINDOW
    v = F.when(a.between(lo, hi), a)
    return df.agg(F.count(v).alias("customers"), rnd(F.min(v), digits).alias("youngest"),
                  rnd(F.max(v), digits).alias("oldest"), rnd(F.avg(v), digits).alias("mean_age"),
                  rnd(F.median(v), digits).alias("median_age"))


def tenant_domain(df: DataFrame, table: str) -> DataFrame:
    """Q12: unexpected distinct tenant values (not LV1 / LV2) with their row counts."""
    m = F.col("mandantid")
    return (df.where(m.isNotNull() & ~m.isin(*rules.TENANTS)).groupBy("mandantid")
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(table).alias("table_name"), F.col("mandantid").alias("unexpected_value"), "rows"))


def tenant_frequency(df: DataFrame) -> DataFrame:
    """Q13: rows per tenant value (NULL excluded)."""
    return df.where(F.col("mandantid").isNotNull()).groupBy("mandantid").agg(F.count(F.lit(1)).alias("rows"))


def numeric_profile(df: DataFrame, table: str, digits: int | None = 2) -> DataFrame:
    """Q14/Q15: per numeric column range and mean; negatives for value-named columns."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if not num:
        return df.sparkSession.createDataFrame(
            [], "table_name string, column string, non_null long, negatives long, "
                "min_value double, max_value double, mean_value double")
    aggs = []
    for c in num:
        x = F.col(c).cast("double")
        neg = F.count_if(x < 0).cast("long") if VALUE_NAME_PATTERN.search(c) else F.lit(None).cast("long")
        aggs += [F.count(x).alias(f"{c}__n"), neg.alias(f"{c}__neg"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max"), F.avg(x).alias(f"{c}__avg")]
    wide = df.agg(*aggs)
    return _union([wide.select(
        F.lit(table).alias("table_name"), F.lit(c).alias("column"), F.col(f"{c}__n").alias("non_null"),
        F.col(f"{c}__neg").alias("negatives"), rnd(f"{c}__min", digits).alias("min_value"),
        rnd(f"{c}__max", digits).alias("max_value"), rnd(f"{c}__avg", digits).alias("mean_value"))
        for c in num])


# ------------------------------------------------------------------ referential checks

def key_counts(contracts: DataFrame, customers: DataFrame, series: DataFrame) -> DataFrame:
    """Q16: distinct non-null keys per table."""
    return _union([
        keysets.key_set(df, key).agg(F.lit(name).alias("table_name"), *keysets.size("bits")).withColumnRenamed("bits", "distinct_keys")
        for name, df, key in (("contracts", contracts, "contractid"), ("customers", customers, "customerid"),
                              ("timeseries", series, "contractid"))])


def _with_customer(contracts: DataFrame, customers: DataFrame) -> DataFrame:
    """The contracts that have a customer, as a key set.

    When customers carry ``contractid`` (the reference's layout) a contract has customer
    data if its id appears there; otherwise through ``customerid``.
    """
    if "contractid" in customers.columns:
        return keysets.key_set(customers, "contractid")
    links = contracts.where(F.col("contractid").isNotNull()).select("contractid", "customerid")
    return keysets.key_set(keysets.having(links, "customerid", keysets.key_set(customers, "customerid")), "contractid")


def key_coverage(contracts: DataFrame, customers: DataFrame, series: DataFrame,
                 digits: int | None = 1) -> DataFrame:
    """Q17: contracts -> customers and contracts -> series: matched, missing, coverage %."""
    links = keysets.side_by_side(keysets.key_set(contracts, "contractid"), m_cust=_with_customer(contracts, customers),
                                 m_ts=keysets.key_set(series, "contractid")) \
        .agg(*keysets.size("bits", "m_cust", "m_ts")).withColumnRenamed("bits", "contracts")

    def rel(name, m):
        return F.struct(F.lit(name).alias("relation"), "contracts", F.col(m).alias("matched"),
                        (F.col("contracts") - F.col(m)).alias("missing"),
                        rnd(F.try_divide(100.0 * F.col(m), F.col("contracts")), digits).alias("coverage_percent"))
    return links.select(F.inline(F.array(rel("contracts_to_customers", "m_cust"), rel("contracts_to_timeseries", "m_ts"))))


def missing_customers(contracts: DataFrame, customers: DataFrame) -> DataFrame:
    """Q18: contracts whose customer is absent from customers (or that name none)."""
    links = contracts.where(F.col("contractid").isNotNull()).select("contractid", "customerid")
    return keysets.having(links, "customerid", keysets.key_set(customers, "customerid"), inside=False).distinct()


def missing_series(contracts: DataFrame, series: DataFrame) -> DataFrame:
    """Q18: contracts without any series row."""
    return keysets.members(keysets.minus(keysets.key_set(contracts, "contractid"), keysets.key_set(series, "contractid")),
                           "contractid")


def orphan_keys(contracts: DataFrame, customers: DataFrame, series: DataFrame) -> DataFrame:
    """Q19: customers no contract refers to and series keys without a contract (reported, not issues).

    Customers link by ``contractid`` when they carry it (the reference's layout), else by
    ``customerid``.
    """
    link = "contractid" if "contractid" in customers.columns else "customerid"
    oc = keysets.minus(keysets.key_set(customers, link), keysets.key_set(contracts, link))
    ot = keysets.minus(keysets.key_set(series, "contractid"), keysets.key_set(contracts, "contractid"))

    def summary(found, kind):
        n = found.agg(*keysets.size("bits")).withColumnRenamed("bits", "orphans")
        ex = keysets.members(found, "key").orderBy("key").limit(DUPLICATE_EXAMPLES).agg(_examples("key", "examples"))
        return one_row(n, ex).select(F.lit(kind).alias("kind"), "orphans", "examples")
    return summary(oc, "customers_without_contract").unionByName(summary(ot, "timeseries_without_contract"))


# ------------------------------------------------------------------ issue totals

def table_issues(df: DataFrame, table: str, as_of: dt.date) -> DataFrame:
    """Q20: basic issues (missing + duplicate rows + repeated contract ids) and business issues
    (invalid ids or 1 when all ids are missing, births out of range, unexpected tenants,
    negative values) for one table; one row.

    The table is read once, into its distinct rows with their counts; every number is one
    aggregate over these: counts weighted by the repeats, repeated rows and ids as rows less
    distinct ones (NULL is one id), unexpected tenants as distinct values.
    """
    weighted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    zero = F.lit(0).cast("long")

    def rows_where(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, F.col("__n"))), zero)
    n = F.coalesce(F.sum("__n"), zero)
    basic = [rows_where(_missing(df, c)) for c in df.columns] + [n - F.count(F.lit(1))]
    business = []
    for col in ("contractid", "customerid"):
        if col in df.columns:
            c = F.col(col).cast("string")
            non_empty = c.isNotNull() & (c != "")
            business.append(rows_where(non_empty & ~c.rlike(ID_PATTERNS[col])))
            if col == "contractid":
                business.append(F.when(F.count_if(non_empty) == 0, F.lit(1)).otherwise(F.lit(0)))
                null_id = F.when(F.count_if(F.col(col).isNull()) > 0, F.lit(1)).otherwise(F.lit(0))
                basic.append(n - F.count_distinct(col) - null_id)
    if "birthdate" in df.columns:
        b = F.col("birthdate")
        business += [rows_where(b > F.lit(as_of)), rows_where(b < F.lit(rules.MIN_BIRTHDATE))]
    business += [rows_where(F.col(f.name) < 0) for f in df.schema.fields
                 if isinstance(f.dataType, T.NumericType) and VALUE_NAME_PATTERN.search(f.name)]
    if "mandantid" in df.columns:
        m = F.col("mandantid")
        business.append(F.count_distinct(F.when(~m.isin(*rules.TENANTS), m)))
    out = weighted.agg(reduce(lambda a, b: a + b, basic, zero).cast("long").alias("basic_issues"),
                       reduce(lambda a, b: a + b, business, zero).cast("long").alias("business_issues"))
    return out.select(F.lit(table).alias("table_name"), "basic_issues", "business_issues",
                      (F.col("basic_issues") + F.col("business_issues")).alias("issues_found"))


def referential_issues(contracts: DataFrame, customers: DataFrame, series: DataFrame) -> DataFrame:
    """Q20: contracts lacking customers + contracts lacking series."""
    cov = key_coverage(contracts, customers, series)
    return cov.agg(F.lit("referential_integrity").alias("table_name"),
                   F.lit(0).cast("long").alias("basic_issues"),
                   F.sum("missing").cast("long").alias("business_issues")) \
              .withColumn("issues_found", F.col("business_issues"))


def quality_summary(tables: dict[str, DataFrame | None], clean: dict[str, DataFrame],
                    as_of: dt.date) -> DataFrame:
    """Q20/Q21: issues per table, referential issues; an absent table counts 999 (ref 1)."""
    present = [df for df in (*tables.values(), *clean.values()) if df is not None]
    spark = present[0].sparkSession if present else SparkSession.active()
    rows = []
    for name in ("contracts", "customers", "timeseries"):
        df = tables.get(name)
        if df is None:
            rows.append(spark.createDataFrame([(name, None, None, 999)],
                                              "table_name string, basic_issues long, business_issues long, "
                                              "issues_found long"))
        else:
            rows.append(table_issues(df, name, as_of))
    if all(clean.get(n) is not None for n in ("contracts", "customers", "timeseries")):
        rows.append(referential_issues(clean["contracts"], clean["customers"], clean["timeseries"]))
    else:
        rows.append(spark.createDataFrame([("referential_integrity", 0, 1, 1)],
                                          "table_name string, basic_issues long, business_issues long, "
                                          "issues_found long"))
    return _union(rows)


def total_issues(summary: DataFrame) -> DataFrame:
    """Q20: the grand total over the rows of :func:`quality_summary`, absent tables included."""
    return summary.agg(F.lit("total").alias("table_name"),
                       F.coalesce(F.sum("issues_found"), F.lit(0)).cast("long").alias("total_issues"))
