"""Statistics building blocks shared by the operators.

* ANSI-safe correlation / slope / R^2 (Spark raises on a constant group under ANSI).
* Binning by left-closed breaks, the ``cut(..., right = FALSE)`` rule.
* Percent of total over a small (already aggregated) table.
* Exact quantiles per group that never gather one group in one task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c, digits: int | None) -> Column:
    """``round`` when ``digits`` is given, identity otherwise."""
    c = _col(c)
    return c if digits is None else F.round(c, digits)


def one_row(*frames: DataFrame) -> DataFrame:
    """Columns of several one-row aggregates side by side, without any join.

    The first frame is the outer query; every other frame enters as one uncorrelated
    scalar subquery (a struct of its columns), which Spark runs once and inlines.
    """
    base = frames[0]
    cols = [F.col(c) for c in base.columns]
    for f in frames[1:]:
        s = f.select(F.struct(*[F.col(c) for c in f.columns]).alias("_s")).scalar()
        cols += [s.getField(c).alias(c) for c in f.columns]
    return base.select(*cols)


# --------------------------------------------------------------------------- #
# Guarded moments: partial-aggregatable, never divide by zero.
# --------------------------------------------------------------------------- #

def safe_corr(y, x) -> Column:
    """Pearson r; NULL when either side is constant (R gives NA, DuckDB NaN)."""
    y, x = _col(y), _col(x)
    return F.when(
        (F.min(y) < F.max(y)) & (F.min(x) < F.max(x)),
        F.try_divide(F.covar_pop(y, x), F.stddev_pop(y) * F.stddev_pop(x)),
    )


def safe_slope(y, x) -> Column:
    """OLS slope of ``y ~ x``; NULL when ``x`` is constant."""
    y, x = _col(y), _col(x)
    return F.when(F.min(x) < F.max(x), F.try_divide(F.covar_pop(y, x), F.var_pop(x)))


def safe_r2(y, x) -> Column:
    """R^2 of the simple regression = r^2; NULL when undefined."""
    r = safe_corr(y, x)
    return r * r


# --------------------------------------------------------------------------- #
# Binning
# --------------------------------------------------------------------------- #

def bin_left_closed(c, breaks: Sequence[float], labels: Sequence[str],
                    include_last: bool = False) -> Column:
    """Label of ``[b_i, b_{i+1})``; outside ``[b_0, b_k)`` (and NaN) -> NULL.

    ``include_last`` closes the last interval on the right as well.
    """
    if len(labels) != len(breaks) - 1:
        raise ValueError(f"{len(breaks)} breaks need {len(breaks) - 1} labels, got {len(labels)}")
    c = _col(c)
    out = None
    for i, lab in enumerate(labels):
        lo, hi = breaks[i], breaks[i + 1]
        cond = c >= F.lit(float(lo))
        if not math.isinf(hi):
            last = include_last and i == len(labels) - 1
            cond = cond & ((c <= F.lit(float(hi))) if last else (c < F.lit(float(hi))))
        cond = cond & ~F.isnan(c)
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def label_rank(c, labels: Sequence[str]) -> Column:
    """Position of a label in ``labels`` (1-based) for ordering ordered factors."""
    return F.array_position(F.array(*[F.lit(x) for x in labels]), _col(c)).cast("int")


# --------------------------------------------------------------------------- #
# Percent of total on a small aggregated frame
# --------------------------------------------------------------------------- #

def percent_of_total(count_col: str, partition: Sequence[str] = (), digits: int | None = 1) -> Column:
    """``100 * n / sum(n)`` over the (small, aggregated) frame or within ``partition``."""
    w = Window.partitionBy(*partition) if partition else Window.partitionBy()
    return rnd(F.try_divide(100.0 * F.col(count_col), F.sum(count_col).over(w)), digits)


# --------------------------------------------------------------------------- #
# Exact quantiles
# --------------------------------------------------------------------------- #

def _slice_of(value: Column, bounds: Column, count: int) -> Column:
    """How many of the ``count`` ascending ``bounds`` lie at or below ``value``: a binary search of log2(count) steps."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(count.bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda i, s: F.when(
        (i + s <= F.size(bounds)) & (F.get(bounds, i + s - 1) <= value), i + s).otherwise(i))
    return F.coalesce(found, F.lit(0))          # never NULL, so no join pushes a test of it below the counting


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Sequence[float], names: Sequence[str],
                    slices: int | None = None) -> DataFrame:
    """Exact type-7 quantiles of ``value`` per ``keys`` (linear interpolation).

    Same numbers as ``percentile``/``median``, but no group is ever held by one task:

    1. value counts per ``(keys, value)`` (partial aggregation collapses repeats);
    2. boundary values cut these into ``slices`` of about equal length: a bounded sketch
       (``percentile_approx``) of the counted values, read as a scalar subquery when the query
       runs. The slice is a function of the value alone, so even a hot group spreads over many
       tasks, and any recomputation deals the values alike;
    3. within a ``(keys, slice)`` a running count, plus the offset of the slice from a table
       with one row per ``(keys, slice)``, gives every distinct value its ranks;
    4. only the slices and then the rows holding the target ranks survive, then one small ``groupBy``.

    The values cross the network twice: to be counted and to be ranked. Nothing runs while the
    plan is built. ``slices`` defaults to four per shuffle partition, 20,000 at most. NULL keys
    are groups like any other.

    Returns ``keys + names`` with one row per group that has a non-null value.
    """
    keys = list(keys)
    v = F.col("_v")
    base = df.select(group_key(keys), F.col(value).alias("_v")).where(v.isNotNull() & ~F.isnan(v))
    counts = base.groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_c"))
    return quantiles_of_counts(counts, keys, probs, names, slices)


def group_key(keys: Sequence[str]) -> Column:
    """The keys as one struct ``_k``: equal also where a field is NULL, in groupings and plain joins."""
    return (F.struct(*[F.col(c) for c in keys]) if keys else F.struct(F.lit(0).alias("all"))).alias("_k")


def quantiles_of_counts(counts: DataFrame, keys: Sequence[str], probs: Sequence[float],
                        names: Sequence[str], slices: int | None = None) -> DataFrame:
    """:func:`exact_quantiles` of values that are counted already: ``(_k, _v, _c)``, one row per
    ``(_k, _v)``, ``_k`` by :func:`group_key`. Values with count 0 take no part."""
    keys = list(keys)
    v = F.col("_v")
    if slices is None:
        slices = min(20_000, max(64, 4 * int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    # reading the count as well makes this the same exchange as the one ranked below
    bounds = counts.agg(F.percentile_approx(F.when(F.col("_c") > 0, v), [i / slices for i in range(1, slices)], max(10_000, 10 * slices))).scalar()
    cut = counts.withColumn("_b", bounds).withColumn("_s", _slice_of(v, F.col("_b"), slices - 1)).drop("_b")
    up_to = Window.partitionBy("_k", "_s").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = cut.withColumn("_hi", F.sum("_c").over(up_to))

    sums = cut.groupBy("_k", "_s").agg(F.sum("_c").alias("_t"))
    before = Window.partitionBy("_k").orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    sums = (sums.withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0)))
            .withColumn("_n", F.sum("_t").over(Window.partitionBy("_k"))))
    for i, q in enumerate(probs):
        pos = F.lit(1.0) + (F.col("_n") - 1) * F.lit(float(q))
        sums = (sums.withColumn(f"_lo{i}", F.floor(pos))
                .withColumn(f"_up{i}", F.ceil(pos))
                .withColumn(f"_fr{i}", pos - F.floor(pos)))

    def in_slice(rank: str) -> Column:
        return (F.col(rank) > F.col("_off")) & (F.col(rank) <= F.col("_off") + F.col("_t"))
    # slices that hold a target rank, at most two per group and quantile
    wanted = sums.where(reduce(lambda a, b: a | b, [in_slice(f"_{e}{i}") for i in range(len(probs)) for e in ("lo", "up")]))
    g = ranked.join(wanted.drop("_t", "_n"), ["_k", "_s"])
    g = g.withColumn("_hi", F.col("_hi") + F.col("_off")).withColumn("_lo", F.col("_hi") - F.col("_c") + 1)

    def holds(rank: str) -> Column:
        return (F.col("_lo") <= F.col(rank)) & (F.col(rank) <= F.col("_hi"))
    aggs = []
    for i in range(len(probs)):
        aggs += [F.max(F.when(holds(f"_lo{i}"), v)).alias(f"_a{i}"),
                 F.max(F.when(holds(f"_up{i}"), v)).alias(f"_b{i}"),
                 F.max(f"_fr{i}").alias(f"_f{i}")]
    out = g.groupBy("_k").agg(*aggs)
    # an exact rank returns its value as is (no 0 * (b - a) term, which is NaN for infinities)
    return out.select(*[F.col("_k").getField(c).alias(c) for c in keys], *[
        F.when(F.col(f"_f{i}") == 0, F.col(f"_a{i}"))
         .otherwise(F.col(f"_a{i}") + F.col(f"_f{i}") * (F.col(f"_b{i}") - F.col(f"_a{i}"))).alias(name)
        for i, name in enumerate(names)
    ])


def quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
              names: Sequence[str], accuracy: int | None = None) -> DataFrame:
    """Quantiles per group: exact by default (:func:`exact_quantiles`).

    With ``accuracy`` set, ``percentile_approx`` is used instead: one partial-aggregate
    pass with memory bounded by ``accuracy`` per group, relative rank error ~1/accuracy.
    """
    if accuracy is None:
        return exact_quantiles(df, keys, value, probs, names)
    v = F.col(value)
    base = df.where(v.isNotNull() & ~F.isnan(v))
    q = F.percentile_approx(value, list(probs), accuracy)
    out = base.groupBy(*keys).agg(q.alias("_q"))
    return out.select(*keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])
