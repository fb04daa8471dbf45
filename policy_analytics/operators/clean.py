"""Cleaning (C1-C17): standardise names, convert values, drop / impute / keep, dedupe, audit.

``clean_table`` returns the cleaned DataFrame (lazy) and a one-row audit DataFrame. The
audit is one aggregate over a frame that carries raw and converted columns side by side
(the final row count is a distinct count of the cleaned row inside it), instead of a
count after every rule.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules
from ..functions.names import standardise_columns
from ..session import together

# The critical key columns per table type (rows without them are dropped).
CRITICAL_KEYS = {
    "contracts": ("contractid",),
    "customers": ("customerid",),
    "timeseries": ("contractid", "date"),
}

LOG_SCHEMA = T.StructType([
    T.StructField("table_type", T.StringType()),
    T.StructField("original_rows", T.LongType()),
    T.StructField("original_cols", T.LongType()),
    T.StructField("final_rows", T.LongType()),
    T.StructField("final_cols", T.LongType()),
    T.StructField("dropped_rows", T.LongType()),
    T.StructField("imputed_values", T.LongType()),
    T.StructField("rows_retained_percent", T.DoubleType()),
])


@dataclass
class Policy:
    """C17: per-field strategy (drop / impute / keep) and the optional rule switches."""
    impute_tenant: bool = True
    strict_ids: bool = False
    casefold_tenant: bool = False
    decimal_comma: bool = False
    dedupe: bool = True


@dataclass
class CleanResult:
    data: DataFrame
    log: DataFrame
    converted: list[str] = field(default_factory=list)
    renamed: list[str] = field(default_factory=list)
    make_log: object = None
    staged: DataFrame | None = None


def _count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("long")


def convert(df: DataFrame, table_type: str, as_of: dt.date, policy: Policy = Policy()):
    """Standardised frame with converted columns and metric expressions.

    Returns ``(frame, converted, renamed, metrics)``; ``frame`` keeps the raw value of
    every converted column as ``__raw_<name>`` and every parsed date as ``__parsed_<name>``;
    ``metrics`` are the conditions whose rows the audit counts.
    """
    df, renamed = standardise_columns(df, table_type)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    cols = df.columns
    new: dict[str, Column] = {}
    metrics: dict[str, Column] = {}
    converted: list[str] = []

    def raw(c):
        return F.col(f"__raw_{c}")

    def conv(c):
        return F.col(c)

    for c, letter, pat in (("contractid", "V", rules.CONTRACT_ID_PATTERN),
                           ("customerid", "K", rules.CUSTOMER_ID_PATTERN)):
        if c in cols:
            new[c] = rules.clean_prefixed_id(c, letter, policy.strict_ids)
            converted.append(c)
            metrics[f"{c}_invalid_before"] = raw(c).isNotNull() & ~raw(c).cast("string").rlike(pat)
            metrics[f"{c}_invalid_after"] = conv(c).isNotNull() & ~conv(c).rlike(pat)
    if "mandantid" in cols:
        new["mandantid"] = rules.clean_tenant("mandantid", policy.casefold_tenant)
        converted.append("mandantid")
        metrics["mandantid_invalid_before"] = (
            raw("mandantid").isNotNull() & ~raw("mandantid").cast("string").isin(*rules.TENANTS))
        metrics["mandantid_invalid_after"] = (
            conv("mandantid").isNotNull() & ~conv("mandantid").isin(*rules.TENANTS))
    parsed: dict[str, Column] = {}
    for c, parse, low in (("birthdate", rules.parse_date_multi, rules.MIN_BIRTHDATE),
                          ("date", rules.parse_date_iso, rules.MIN_SERIES_DATE)):
        if c in cols:
            parsed[f"__parsed_{c}"] = parse(c, types[c])
            new[c] = rules.within_dates(F.col(f"__parsed_{c}"), low, as_of)
            converted.append(c)
            metrics[f"{c}_invalidated"] = F.col(f"__parsed_{c}").isNotNull() & conv(c).isNull()
    if "surrender_value" in cols:
        parsed["__parsed_surrender_value"] = rules.signed_amount("surrender_value", types["surrender_value"], policy.decimal_comma)
        signed = F.col("__parsed_surrender_value")
        new["surrender_value"] = F.when(signed >= 0, signed)
        converted.append("surrender_value")
        metrics["negative_values"] = signed < 0

    frame = df.select(*[F.col(c).alias(f"__raw_{c}") for c in converted], *df.columns)
    frame = frame.withColumns(parsed) if parsed else frame
    frame = frame.withColumns(new) if new else frame
    return frame, converted, renamed, metrics


def _spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if its scan has fewer partitions than that (parsing text is the costly part)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


# Bits of the bitmap that distinct_rows broadcasts, whatever the table's size: 131,072 words at most.
TWIN_BITS = 1 << 23


def distinct_rows(rows: DataFrame) -> DataFrame:
    """``rows`` without repeats; only rows with a suspected twin cross the network whole.

    Digests of 64 bits are counted first. Those that repeat are marked in a bitmap of fixed size;
    a row whose bit is clear has no twin and stays where it is, the others are grouped by all
    their columns, so digests and bits that merely collide cost a shuffle but never a row.
    ``rows`` is read twice and must be cheap to read and the same both times (a written table).
    """
    cols = rows.columns
    place = F.pmod(F.xxhash64(*cols), F.lit(TWIN_BITS))
    repeated = (rows.groupBy(F.xxhash64(*cols).alias("h")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                .select(F.pmod("h", F.lit(TWIN_BITS)).alias("place")))
    marks = F.broadcast(repeated.groupBy(F.expr("place div 64").alias("__word"))
                        .agg(F.bit_or(F.expr("shiftleft(1L, int(place % 64))")).alias("__bits")))
    seen = (rows.withColumn("__place", place).withColumn("__word", F.expr("__place div 64")).join(marks, "__word", "left")
            .withColumn("__twin", F.expr("coalesce(getbit(__bits, int(__place % 64)) = 1, false)")))
    suspected = seen.where("__twin").groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).select(*cols)
    return seen.where(~F.col("__twin")).select(*cols).unionByName(suspected)


def clean_table(df: DataFrame, table_type: str, as_of: dt.date,
                policy: Policy = Policy(), staging: str | None = None) -> CleanResult:
    """C1-C14 for one table: cleaned data plus a one-row audit record.

    With ``staging``, a folder in shared storage, the converted rows and the audit's flags are
    written there once, and table, audit and key histogram all read that: the raw table is read
    and parsed a single time. Rows are then deduplicated by digest (:func:`distinct_rows`).
    """
    original_cols = len(df.columns)
    if staging is not None:
        df = _spread(df)
    frame, converted, renamed, conditions = convert(df, table_type, as_of, policy)
    out_cols = [c for c in frame.columns if not c.startswith(("__raw_", "__parsed_"))]
    if staging is not None:
        frame = frame.select(*out_cols, *[cond.alias(f"__flag_{k}") for k, cond in conditions.items()])
        frame.write.parquet(staging)
        frame = df.sparkSession.read.schema(frame.schema).parquet(staging)
        conditions = {k: F.col(f"__flag_{k}") for k in conditions}
    metrics = {k: _count_if(cond) for k, cond in conditions.items()}
    keys = [k for k in CRITICAL_KEYS.get(table_type, ()) if k in out_cols]
    key_ok = F.lit(True)
    for k in keys:
        key_ok = key_ok & F.col(k).isNotNull()

    # C9 + C12. Drop-then-dedupe equals dedupe-then-drop (the keys are part of the row), and
    # the second order lets the key test ride along as an aggregate: a filter on an
    # aggregate output is not pushed below it, so the converted (regex-parsed) columns are
    # computed once per row instead of again inside a pushed-down filter.
    ok = "__key_ok"
    conv = frame.select(*out_cols, key_ok.alias(ok))
    imputed_tenant = None
    if table_type == "contracts" and "mandantid" in out_cols and policy.impute_tenant:
        # Mode after C9, lowest label on a tie; all-NULL -> nothing imputed.
        tenant_mode = conv.where(F.col(ok)).agg(F.mode("mandantid", True).alias("__mode")).scalar()
        imputed_tenant = F.coalesce("mandantid", tenant_mode)
        conv = conv.withColumn("mandantid", imputed_tenant)
    if policy.dedupe and staging is not None:
        data = distinct_rows(conv.where(F.col(ok)).select(*out_cols))
    elif policy.dedupe:
        data = (conv.groupBy(*out_cols).agg(F.max(ok).alias(ok))
                .where(F.col(ok)).select(*out_cols))
    else:
        data = conv.where(F.col(ok)).select(*out_cols)

    # One aggregate over the converted frame. The final row count is a
    # distinct count of the cleaned row in the same aggregate (one scan, one shuffle).
    m = dict(metrics)
    m["original_rows"] = F.count(F.lit(1)).cast("long")
    m["null_key_rows"] = _count_if(~key_ok)
    if "mandantid" in out_cols and table_type == "contracts":
        m["missing_tenant"] = _count_if(key_ok & F.col("mandantid").isNull())
        m["has_tenant"] = _count_if(key_ok & F.col("mandantid").isNotNull())
    if "birthdate" in out_cols:
        m["missing_birthdate_kept"] = _count_if(key_ok & F.col("birthdate").isNull())
    if "surrender_value" in out_cols:
        m["missing_value_kept"] = _count_if(key_ok & F.col("surrender_value").isNull())
    row = F.struct(*[(imputed_tenant.alias(c) if c == "mandantid" and imputed_tenant is not None else F.col(c))
                     for c in out_cols])
    final_expr = (F.count_distinct(F.when(key_ok, row)) if policy.dedupe else _count_if(key_ok)).cast("long")
    stats = frame.agg(*[v.alias(k) for k, v in m.items()])
    stats_with_final = frame.agg(*[v.alias(k) for k, v in m.items()], final_expr.alias("final_rows"))

    def make_log(final_rows: int | None = None) -> DataFrame:
        """The audit row; ``final_rows`` given (e.g. counted from written files) skips the distinct count."""
        log = (stats_with_final if final_rows is None
               else stats.select("*", F.lit(final_rows).cast("long").alias("final_rows")))
        return _finish_log(log, table_type, original_cols, out_cols, keys, m, metrics,
                           converted, renamed, policy)

    return CleanResult(data=data, log=make_log(), converted=converted, renamed=renamed, make_log=make_log,
                       staged=frame.select(*out_cols) if staging is not None else None)


def _finish_log(log, table_type, original_cols, out_cols, keys, m, metrics, converted, renamed, policy):
    """Shape the one-row metrics + final count into the audit record (C14)."""
    imputed = (F.when(F.col("has_tenant") > 0, F.col("missing_tenant")).otherwise(F.lit(0))
               if "missing_tenant" in m and policy.impute_tenant else F.lit(0)).cast("long")
    after_drop = F.col("original_rows") - F.col("null_key_rows")
    dup_removed = after_drop - F.col("final_rows")
    actions = []
    for c in ("contractid", "customerid", "mandantid"):
        if f"{c}_invalid_before" in m:
            actions.append(F.format_string(f"Fixed %d {c} formats",
                                           F.col(f"{c}_invalid_before") - F.col(f"{c}_invalid_after")))
    if "birthdate_invalidated" in m:
        actions.append(F.format_string("Converted birthdate to Date, removed %d invalid dates",
                                       F.col("birthdate_invalidated")))
    if "negative_values" in m:
        actions.append(F.format_string("Converted surrender_value to numeric, removed %d negative values",
                                       F.col("negative_values")))
    actions.append(F.format_string("Dropped %d rows without " + " or ".join(keys), F.col("null_key_rows")))
    if "missing_tenant" in m and policy.impute_tenant:
        actions.append(F.format_string("Imputed %d missing mandantid values", imputed))
    actions.append(F.format_string("Removed %d duplicate rows", dup_removed))

    log = log.select(
        F.lit(table_type).alias("table_type"),
        "original_rows",
        F.lit(original_cols).cast("long").alias("original_cols"),
        "final_rows",
        F.lit(len(out_cols)).cast("long").alias("final_cols"),
        (F.col("null_key_rows") + dup_removed).alias("dropped_rows"),
        imputed.alias("imputed_values"),
        F.round(F.try_divide(100.0 * F.col("final_rows"), F.col("original_rows")), 1).alias("rows_retained_percent"),
        F.col("null_key_rows").alias("null_key_rows"),
        dup_removed.alias("duplicates_removed"),
        *[F.col(k) for k in metrics],
        *[F.col(k) for k in ("missing_birthdate_kept", "missing_value_kept") if k in m],
        F.array(*[F.lit(c) for c in converted]).cast("array<string>").alias("converted_columns"),
        F.array(*[F.lit(r) for r in renamed]).cast("array<string>").alias("renamed_columns"),
        F.array(*actions).alias("actions_taken"),
    )
    return log


def clean_all(tables: dict[str, DataFrame | None], as_of: dt.date,
              policy: Policy = Policy()) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """Clean every present table; logs as one frame (common columns, by name)."""
    data, results = clean_all_results(tables, as_of, policy)
    return data, union_logs(results)


def clean_all_results(tables: dict[str, DataFrame | None], as_of: dt.date, policy: Policy = Policy(),
                      staging: str | None = None) -> tuple[dict[str, DataFrame], dict[str, CleanResult]]:
    """C15 with the per-table results (for logs built from written row counts); ``staging``: see :func:`clean_table`."""
    present = {n: df for n, df in tables.items() if df is not None}
    calls = [lambda n=n, df=df: clean_table(df, n, as_of, policy, f"{staging.rstrip('/')}/{n}" if staging else None)
             for n, df in present.items()]
    results = dict(zip(present, together(calls) if staging else [c() for c in calls], strict=True))
    return {n: r.data for n, r in results.items()}, results


def union_logs(results: dict[str, CleanResult], counts: dict[str, int | None] | None = None) -> DataFrame | None:
    """The audit rows of several tables as one frame; ``counts`` = known final row counts."""
    cols = [*LOG_SCHEMA.fieldNames(), "null_key_rows", "duplicates_removed"]
    log = None
    for name, r in results.items():
        lg = (r.make_log(counts.get(name)) if counts else r.log).select(*cols)
        log = lg if log is None else log.unionByName(lg)
    return log


def full_logs(results: dict[str, CleanResult], counts: dict[str, int | None] | None = None) -> DataFrame | None:
    """The whole audit row of every table as ``(table_type, log_json)``; no field is left out."""
    log = None
    for name, r in results.items():
        row = r.make_log(counts.get(name)) if counts else r.log
        row = row.select("table_type", F.to_json(F.struct(*row.columns)).alias("log_json"))
        log = row if log is None else log.unionByName(row)
    return log


def pipeline_totals(log: DataFrame) -> DataFrame:
    """Per table and overall rows and retention %."""
    per = log.select("table_type", "original_rows", "final_rows",
                     (F.col("original_rows") - F.col("final_rows")).alias("removed_rows"),
                     "rows_retained_percent")
    total = log.agg(
        F.lit("total").alias("table_type"),
        F.sum("original_rows").cast("long").alias("original_rows"),
        F.sum("final_rows").cast("long").alias("final_rows"),
    ).withColumn("removed_rows", F.col("original_rows") - F.col("final_rows")) \
     .withColumn("rows_retained_percent",
                 F.round(F.try_divide(100.0 * F.col("final_rows"), F.col("original_rows")), 1))
    return per.unionByName(total)


def format_fixes(log: DataFrame) -> DataFrame:
    """Invalid-before / invalid-after / fixed per converted id column, long form."""
    parts = []
    for c in ("contractid", "customerid", "mandantid"):
        b, a = f"{c}_invalid_before", f"{c}_invalid_after"
        if b in log.columns:
            parts.append(log.select("table_type", F.lit(c).alias("column"),
                                    F.col(b).alias("invalid_before"), F.col(a).alias("invalid_after"),
                                    (F.col(b) - F.col(a)).alias("fixed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
