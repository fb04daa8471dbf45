"""Tenant ("Mandant") summaries (M1-M6).

There are only a handful of tenants, so every tenant group is a hot group at scale:
counts and moments are partial aggregates; the value quantiles of M4/M5 use the
distributed exact quantile; age medians use ``median`` because ages have a bounded
domain (0.1-year steps).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import require
from ..functions.stats import group_key, percent_of_total, quantiles, quantiles_of_counts, rnd


def tenant_distribution(contracts: DataFrame, digits: int | None = 1) -> DataFrame:
    """M1: contracts per tenant and % (NULL tenant excluded)."""
    require(contracts, ["mandantid"], "contracts")
    c = (contracts.where(F.col("mandantid").isNotNull())
         .groupBy("mandantid").agg(F.count(F.lit(1)).alias("contract_count")))
    return c.withColumn("percentage", percent_of_total("contract_count", digits=digits))


def contracts_with_customers(contracts: DataFrame, customers_with_age: DataFrame) -> DataFrame:
    """Contracts joined to ``(customerid, age, age_group)`` of customers (X14); the band may be absent."""
    cust = customers_with_age.select(*[c for c in ("customerid", "age", "age_group") if c in customers_with_age.columns])
    return (contracts.join(cust, "customerid")
            .where(F.col("mandantid").isNotNull() & F.col("age").isNotNull()))


def tenant_age(contracts: DataFrame, customers_with_age: DataFrame, digits: int | None = 1) -> DataFrame:
    """M2: age statistics of contract holders per tenant."""
    a = F.col("age")
    return contracts_with_customers(contracts, customers_with_age).groupBy("mandantid").agg(
        F.count(F.lit(1)).alias("count"),
        rnd(F.avg(a), digits).alias("mean_age"),
        rnd(F.median(a), digits).alias("median_age"),
        rnd(F.stddev_samp(a), digits).alias("std_age"),
        rnd(F.min(a), digits).alias("min_age"),
        rnd(F.max(a), digits).alias("max_age"),
    )


def tenant_age_bands(contracts: DataFrame, customers_with_age: DataFrame, digits: int | None = 1) -> DataFrame:
    """M3 (and D2): contracts per tenant x band and % within the tenant."""
    j = contracts_with_customers(contracts, customers_with_age).where(F.col("age_group").isNotNull())
    c = j.groupBy("mandantid", "age_group").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("percentage", percent_of_total("n", ["mandantid"], digits))


def tenant_value_counts(timeseries: DataFrame, contracts: DataFrame) -> DataFrame:
    """Weighted values per tenant: ``(_k, _v, _c)`` with ``_k`` = struct(mandantid).

    The series is counted per ``(contractid, value)`` before tenants are joined, so the join
    sees every distinct value of a contract once. The same aggregate gives one more row per
    contract, with a NULL value: these rows count a tenant's contracts (``_v`` NULL). A contract
    that is listed several times under a tenant counts its values as often, itself once.
    """
    counted = (timeseries.select("contractid", "surrender_value").where("contractid IS NOT NULL AND surrender_value IS NOT NULL")
               .groupingSets([["contractid", "surrender_value"], ["contractid"]], "contractid", "surrender_value")
               .agg(F.count(F.lit(1)).alias("n")))
    listed = (contracts.where(F.col("mandantid").isNotNull() & F.col("contractid").isNotNull())
              .groupBy("contractid", "mandantid").agg(F.count(F.lit(1)).alias("times")))
    weight = F.when(F.col("surrender_value").isNull(), 1).otherwise(F.col("n") * F.col("times"))
    return (counted.join(listed, "contractid")
            .select(group_key(["mandantid"]), F.col("surrender_value").alias("_v"), weight.alias("_w"))
            .groupBy("_k", "_v").agg(F.sum("_w").alias("_c")))


def tenant_values(timeseries: DataFrame, contracts: DataFrame, digits: int | None = 2,
                  accuracy: int | None = None) -> DataFrame:
    """M4: surrender value statistics per tenant incl. exact median and quartiles.

    Everything comes from :func:`tenant_value_counts`, so the series is read and joined once.
    Moments are taken around the mean of the tenant's finite values, which keeps the variance
    free of cancellation. ``accuracy`` switches the quartiles to ``percentile_approx`` (see
    ``stats.quantiles``), which reads the joined series a second time. A tenant with NaN values
    only has no quartiles.
    """
    counts = tenant_value_counts(timeseries, contracts)
    v, c = F.col("_v"), F.col("_c")
    finite = v.isNotNull() & (F.abs(v) < F.lit(float("inf")))
    name = F.col("_k").getField("mandantid")
    # the mean of each tenant in one map: one entry per row of the result
    centres = (counts.groupBy(name.alias("t"))
               .agg(F.try_divide(F.sum(F.when(finite, v * c)), F.sum(F.when(finite, c))).alias("m"))
               .agg(F.map_from_entries(F.collect_list(F.struct("t", F.coalesce("m", F.lit(0.0)))))).scalar())
    off = v - F.try_element_at(F.col("_m"), name)
    n, s1, s2 = F.col("_n"), F.col("_s1"), F.col("_s2")
    # aggregates skip the NULL values of the contract rows
    moments = counts.withColumn("_m", centres).groupBy(name.alias("mandantid")).agg(
        F.sum(F.when(v.isNotNull(), c)).alias("_n"), F.sum(F.when(v.isNull(), c)).alias("_contracts"),
        F.sum(v * c).alias("_sum"), F.sum(off * c).alias("_s1"), F.sum(off * off * c).alias("_s2"),
        F.min(v).alias("_min"), F.max(v).alias("_max"))
    stats = moments.select(
        "mandantid", n.alias("observations"), F.col("_contracts").alias("contracts"),
        rnd(F.try_divide("_sum", n), digits).alias("mean_surrender_value"),
        rnd(F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), F.try_divide(s2 - s1 * s1 / n, n - 1)))), digits).alias("std_surrender_value"),
        rnd("_min", digits).alias("min_surrender_value"),
        rnd("_max", digits).alias("max_surrender_value"),
    )
    probs, names = [0.5, 0.25, 0.75], ["median_surrender_value", "q25_surrender_value", "q75_surrender_value"]
    if accuracy is None:
        counted = counts.select("_k", "_v", F.when(v.isNotNull() & ~F.isnan(v), c).otherwise(0).alias("_c"))
        qs = quantiles_of_counts(counted, ["mandantid"], probs, names)
    else:
        rows = (timeseries.select("contractid", "surrender_value").where(F.col("surrender_value").isNotNull())
                .join(contracts.select("contractid", "mandantid"), "contractid").where(F.col("mandantid").isNotNull()))
        qs = quantiles(rows, ["mandantid"], "surrender_value", probs, names, accuracy)
    qs = qs.select("mandantid", *[rnd(q, digits).alias(q) for q in names])
    return stats.join(qs, "mandantid", "left")


def tenant_volatility(volatility: DataFrame, contracts: DataFrame, digits: int | None = 3,
                      accuracy: int | None = None) -> DataFrame:
    """M5: volatility statistics per tenant and mean risk-adjusted return."""
    j = (volatility.select("contractid", "volatility", "risk_adjusted_return")
         .join(contracts.select("contractid", "mandantid"), "contractid")
         .where(F.col("mandantid").isNotNull() & F.col("volatility").isNotNull()))
    v = F.col("volatility")
    stats = j.groupBy("mandantid").agg(
        F.count(F.lit(1)).alias("contracts"),
        rnd(F.avg(v), digits).alias("mean_volatility"),
        rnd(F.stddev_samp(v), digits).alias("std_volatility"),
        rnd(F.min(v), digits).alias("min_volatility"),
        rnd(F.max(v), digits).alias("max_volatility"),
        rnd(F.avg("risk_adjusted_return"), digits).alias("mean_risk_adjusted_return"),
    )
    med = quantiles(j, ["mandantid"], "volatility", [0.5], ["median_volatility"], accuracy)
    return stats.join(med.select("mandantid", rnd("median_volatility", digits).alias("median_volatility")),
                      "mandantid")


def create_mandant_summaries(contracts: DataFrame, customers_with_age: DataFrame | None = None,
                             timeseries: DataFrame | None = None,
                             volatility: DataFrame | None = None) -> dict[str, DataFrame]:
    """M6: every summary whose inputs are present and carry the needed columns."""
    out = {"distribution": tenant_distribution(contracts)}
    if customers_with_age is not None and "age" in customers_with_age.columns:
        out["age_analysis"] = tenant_age(contracts, customers_with_age)
        if "age_group" in customers_with_age.columns:
            out["age_group_distribution"] = tenant_age_bands(contracts, customers_with_age)
    if timeseries is not None and "surrender_value" in timeseries.columns:
        out["surrender_value_analysis"] = tenant_values(timeseries, contracts)
    if volatility is not None and "volatility" in volatility.columns:
        out["volatility_analysis"] = tenant_volatility(volatility, contracts)
    return out
