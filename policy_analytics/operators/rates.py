"""Rate-series quality and roll-ups (R1-R17), re-aimed to run per key at scale.

Every check takes ``key`` columns (default: none = one series). Order-dependent checks
(gaps, jumps) first reduce the input to one row per ``(key, date)``; a key's window
partition then holds at most one row per calendar day, so neither an unkeyed series nor
a hot contract sends unbounded data to one task. Moments are partial aggregates; the
outlier check joins each row to its key's one-row mean / sd.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules
from ..functions.stats import one_row, quantiles, rnd

# Fixed values of the rate checks: gap and jump thresholds, outlier rule, near-constant
# threshold, staleness days, plausible rate bounds, status tiers, name patterns.
GAP_DAYS = 35
JUMP_POINTS = 2.0
OUTLIER_SIGMAS = 3.0
OUTLIER_MIN_N = 10
CONSTANT_SD = 0.001
STALE_DAYS = 30
AGED_DAYS = 7
RATE_BOUNDS = (-5.0, 25.0)
NO_DATA_ISSUES = 999
MINOR_LIMIT = 10
RATE_NAME_PATTERN = re.compile("rate|interest|yield", re.IGNORECASE)
EXPECTED_RATE_COLUMNS = ("date", "interest_rate", "year_month")


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key or [])


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b), frames)


def _join_keys(left: DataFrame, right: DataFrame, k: list[str]) -> DataFrame:
    """Inner join on the keys in which a NULL key is a group like any other."""
    r = right.select(*[F.col(c).alias(f"__{c}") for c in k], *[c for c in right.columns if c not in k])
    same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(F.col(f"__{c}")) for c in k])
    return left.join(r, same).drop(*[f"__{c}" for c in k])


def month_key(date_col="date") -> Column:
    """``yyyy-MM``."""
    return F.date_format(F.col(date_col), "yyyy-MM")


def monthly_close(daily: DataFrame, digits: int | None = 2) -> DataFrame:
    """R2: per month the last trading date and its close (rounded)."""
    d = daily.where(F.col("close").isNotNull())
    return (d.groupBy(month_key().alias("year_month"))
            .agg(F.max("date").alias("date"), rnd(F.max_by("close", "date"), digits).alias("interest_rate")))


def monthly_rollup(daily: DataFrame, value: str = "interest_rate") -> DataFrame:
    """Per month last date, last non-null rate, true mean (X5), data points."""
    d = daily.where(F.col(value).isNotNull())
    return (d.groupBy(month_key().alias("year_month"))
            .agg(F.max("date").alias("date"), F.max_by(value, "date").alias("interest_rate"),
                 F.avg(value).alias("avg_rate"), F.count(F.lit(1)).alias("data_points")))


def series_summary(df: DataFrame, value: str = "interest_rate") -> DataFrame:
    """Points, date range, rate range."""
    return df.agg(F.count(F.lit(1)).alias("points"), F.min("date").alias("first_date"),
                  F.max("date").alias("last_date"), F.min(value).alias("min_rate"), F.max(value).alias("max_rate"))


def head_tail(df: DataFrame, n: int = 5) -> DataFrame:
    """First and last ``n`` rows in date order (two top-k scans)."""
    first = df.orderBy(F.col("date").asc()).limit(n).withColumn("part", F.lit("first"))
    last = df.orderBy(F.col("date").desc()).limit(n).withColumn("part", F.lit("last"))
    return first.unionByName(last)


def typed_missing(df: DataFrame, digits: int | None = 1) -> DataFrame:
    """Missing by type (numeric NULL / NaN / +-Inf, date NULL, text NULL / "" / "NULL" / "null")."""
    def miss(f: T.StructField) -> Column:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            return c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
        if isinstance(f.dataType, T.StringType):
            return rules.is_missing_text(f.name)
        return c.isNull()
    wide = df.agg(F.count(F.lit(1)).alias("__rows"),
                  *[F.count_if(miss(f)).cast("long").alias(f.name) for f in df.schema.fields])
    return (wide.unpivot("__rows", df.columns, "column", "missing")
            .select("column", "missing",
                    rnd(F.try_divide(100.0 * F.col("missing"), F.col("__rows")), digits).alias("missing_percent")))


def schema_diff(df: DataFrame, expected: Sequence[str] = EXPECTED_RATE_COLUMNS) -> list[tuple[str, str]]:
    """Plan-time set difference: ``(column, "missing" | "extra")``."""
    have = set(df.columns)
    return ([(c, "missing") for c in expected if c not in have]
            + [(c, "extra") for c in df.columns if c not in set(expected)])


def date_checks(df: DataFrame, as_of: dt.date, key=None) -> DataFrame:
    """Per date column range, future dates (warning) and dates before 1900 (issue)."""
    k = _keys(key)
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType))]
    parts = []
    for c in dates:
        d = F.col(c).cast("date")
        parts.append(df.groupBy(*k).agg(
            F.lit(c).alias("column"), F.min(d).alias("min_date"), F.max(d).alias("max_date"),
            F.count_if(d > F.lit(as_of)).cast("long").alias("future_dates"),
            F.count_if(d < F.lit(rules.MIN_BIRTHDATE)).cast("long").alias("dates_before_1900")))
    if not parts:                                       # no date column: no row, no issue
        return _none_of(df, k, "column string, min_date date, max_date date, future_dates long, dates_before_1900 long")
    return _union(parts)


def _none_of(df: DataFrame, k: list[str], rest: str) -> DataFrame:
    """An empty result with the key columns of ``df``."""
    keys = [T.StructField(c, df.schema[c].dataType) for c in k]
    return df.sparkSession.createDataFrame([], T.StructType([*keys, *T._parse_datatype_string(rest).fields]))


def _distinct_dates(df: DataFrame, k: list[str], date_col: str) -> DataFrame:
    return df.where(F.col(date_col).isNotNull()).select(*k, F.col(date_col).cast("date").alias("_d")).distinct()


def gaps(df: DataFrame, key=None, date_col: str = "date", max_days: int = GAP_DAYS) -> DataFrame:
    """Number of consecutive (sorted, distinct) dates more than ``max_days`` apart.

    Windows run on distinct dates per key: at most one row per calendar day per key.
    """
    k = _keys(key)
    d = _distinct_dates(df, k, date_col)
    w = Window.partitionBy(*k).orderBy("_d")
    step = F.datediff("_d", F.lag("_d").over(w))
    return (d.withColumn("_step", step).groupBy(*k)
            .agg(F.count(F.lit(1)).alias("dates"),
                 F.count_if(F.col("_step") > max_days).cast("long").alias("large_gaps"),
                 F.max("_step").alias("max_gap_days")))


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))


def numeric_stats(df: DataFrame, value: str, key=None, digits: int | None = 4,
                  accuracy: int | None = None) -> DataFrame:
    """Finite-only min, max, mean, median (exact and distributed by default), sd per key."""
    k = _keys(key)
    x = F.col(value).cast("double")
    fin = df.select(*k, x.alias(value)).where(_finite(F.col(value)))
    v = F.col(value)
    stats = fin.groupBy(*k).agg(
        F.count(F.lit(1)).alias("n"), rnd(F.min(v), digits).alias("min"), rnd(F.max(v), digits).alias("max"),
        rnd(F.avg(v), digits).alias("mean"), rnd(F.stddev_samp(v), digits).alias("sd"))
    med = quantiles(fin, k, value, [0.5], ["median"], accuracy)
    med = med.select(*k, rnd("median", digits).alias("median"))
    return _join_keys(stats, med, k) if k else one_row(stats, med)


def negatives(df: DataFrame, key=None) -> DataFrame:
    """Negative finite values in columns named like rate / interest / yield."""
    k = _keys(key)
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and RATE_NAME_PATTERN.search(f.name)]
    if not cols:
        return _none_of(df, k, "column string, negatives long")
    return _union([df.groupBy(*k).agg(
        F.lit(c).alias("column"),
        F.count_if(_finite(F.col(c).cast("double")) & (F.col(c) < 0)).cast("long").alias("negatives"))
        for c in cols])


def outliers(df: DataFrame, value: str, key=None, sigmas: float = OUTLIER_SIGMAS,
             min_n: int = OUTLIER_MIN_N) -> DataFrame:
    """Values farther than ``sigmas`` sd from the mean (strict), only where n > ``min_n``.

    Two passes: per-key mean / sd (partial aggregate), then each row joined to its key's
    one row. Unkeyed, the moments enter as one scalar subquery (no join).
    """
    k = _keys(key)
    x = F.col(value).cast("double")
    fin = df.select(*k, x.alias("_x")).where(_finite(F.col("_x")))
    mom = fin.groupBy(*k).agg(F.count(F.lit(1)).alias("n"), F.avg("_x").alias("_m"),
                             F.stddev_samp("_x").alias("_s"))
    if k:
        j = _join_keys(fin, mom, k)
    else:
        m = mom.select(F.struct("n", "_m", "_s").alias("_x")).scalar()
        j = fin.select("_x", m.getField("n").alias("n"), m.getField("_m").alias("_m"), m.getField("_s").alias("_s"))
    out = j.groupBy(*k).agg(
        F.first("n").alias("n"),
        F.count_if(F.abs(F.col("_x") - F.col("_m")) > sigmas * F.col("_s")).cast("long").alias("_o"))
    return out.select(*k, "n", F.when(F.col("n") > min_n, F.col("_o")).alias("outliers"))


def constant_or_empty(df: DataFrame, key=None) -> DataFrame:
    """Per numeric column 1 issue when sd < 0.001 or when no finite value exists."""
    k = _keys(key)
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in k]
    parts = []
    for c in cols:
        x = F.col(c).cast("double")
        fx = F.when(_finite(x), x)
        parts.append(df.groupBy(*k).agg(
            F.lit(c).alias("column"), F.count(fx).alias("finite"), F.stddev_samp(fx).alias("_sd"))
            .select(*k, "column", "finite",
                    F.when(F.col("finite") == 0, F.lit(1))
                     .when(F.col("_sd") < CONSTANT_SD, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("issues")))
    return _union(parts) if parts else _none_of(df, k, "column string, finite long, issues long")


def recency(df: DataFrame, as_of: dt.date, key=None, date_col: str = "date") -> DataFrame:
    """Days since the latest date; > 30 stale, > 7 aged, else fresh; NULL without a date."""
    k = _keys(key)
    r = df.groupBy(*k).agg(F.max(F.col(date_col).cast("date")).alias("latest_date"))
    days = F.datediff(F.lit(as_of), F.col("latest_date"))
    return r.select(*k, "latest_date", days.cast("long").alias("days_old"),
                    F.when(days > STALE_DAYS, "stale").when(days > AGED_DAYS, "aged").when(days.isNotNull(), "fresh")
                    .alias("recency"))


def bounds(df: DataFrame, value: str = "interest_rate", lo: float = RATE_BOUNDS[0],
           hi: float = RATE_BOUNDS[1]) -> DataFrame:
    """Values outside ``[lo, hi]`` (reported only)."""
    v = F.col(value)
    return df.where(v.isNotNull()).agg(F.count(F.lit(1)).alias("rates"),
                                       F.count_if((v < lo) | (v > hi)).cast("long").alias("out_of_bounds"))


def jumps(df: DataFrame, value: str, key=None, threshold: float = JUMP_POINTS, date_col: str = "date") -> DataFrame:
    """Consecutive changes larger than ``threshold`` in date order.

    The series is first reduced to one value per (key, date) -- its mean; a key's
    window then holds at most one row per calendar day.
    """
    k = _keys(key)
    daily = (df.where(F.col(value).isNotNull() & F.col(date_col).isNotNull())
             .groupBy(*k, F.col(date_col).cast("date").alias("_d")).agg(F.avg(value).alias("_v")))
    w = Window.partitionBy(*k).orderBy("_d")
    ch = F.col("_v") - F.lag("_v").over(w)
    return (daily.withColumn("_c", ch).groupBy(*k)
            .agg(F.count(F.lit(1)).alias("points"),
                 F.count_if(F.abs(F.col("_c")) > threshold).cast("long").alias("large_jumps"),
                 F.max(F.abs(F.col("_c"))).alias("max_change")))


def status_tier(issues: Column) -> Column:
    """0 excellent, < 10 minor, else major (999 = no data)."""
    return (F.when(issues == NO_DATA_ISSUES, "no_data").when(issues == 0, "excellent")
            .when(issues < MINOR_LIMIT, "minor").otherwise("major"))


def rate_quality(df: DataFrame | None, as_of: dt.date, expected: Sequence[str] = EXPECTED_RATE_COLUMNS,
                 spark: SparkSession | None = None) -> DataFrame:
    """R5-R16 issue count of one rate table with its status tier.

    issues = typed missing values + missing expected columns + dates before 1900
             + near-constant / all-invalid numeric columns.
    An absent (``None``) or empty table is graded ``no_data`` with 999 issues.
    """
    if df is None:
        spark = spark or SparkSession.active()
        return spark.createDataFrame([(NO_DATA_ISSUES, len(expected), None, None, None, "no_data")],
                                     "issues long, missing_columns long, missing_values long, dates_before_1900 long, "
                                     "constant_or_empty_columns long, status string")
    missing_cols = sum(1 for _, s in schema_diff(df, expected) if s == "missing")
    miss = typed_missing(df).agg(F.sum("missing").alias("_m"))
    old = date_checks(df, as_of).agg(F.coalesce(F.sum("dates_before_1900"), F.lit(0)).alias("_o"))
    const = constant_or_empty(df).agg(F.coalesce(F.sum("issues"), F.lit(0)).alias("_c"))
    rows = df.agg(F.count(F.lit(1)).alias("_n"))
    row = one_row(miss, old, const, rows)
    issues = F.when(F.col("_n") == 0, F.lit(NO_DATA_ISSUES)).otherwise(
        F.coalesce("_m", F.lit(0)) + F.lit(missing_cols) + F.col("_o") + F.col("_c")).cast("long")
    return row.select(issues.alias("issues"), F.lit(missing_cols).cast("long").alias("missing_columns"),
                      F.col("_m").cast("long").alias("missing_values"),
                      F.col("_o").cast("long").alias("dates_before_1900"),
                      F.col("_c").cast("long").alias("constant_or_empty_columns")) \
              .withColumn("status", status_tier(F.col("issues")))


def first_available(sources: Sequence[tuple[str, DataFrame | None]]) -> tuple[str, DataFrame | None]:
    """The first source that is present and has a row (``limit(1)`` probe), with its label."""
    for label, df in sources:
        if df is not None and df.limit(1).count() > 0:
            return label, df.withColumn("source", F.lit(label))
    return "none", None
