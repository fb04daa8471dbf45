"""Combined analyses (D1-D8): enriched contracts, cross tables, leaders, shares, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import one_row, percent_of_total, rnd
from .series import HIGH_CLASSES


def enriched_contracts(contracts: DataFrame, customers_with_age: DataFrame) -> DataFrame:
    """Contracts with holder age and band; tenant and band present."""
    cust = customers_with_age.select("customerid", "age", "age_group")
    return (contracts.join(cust, "customerid")
            .where(F.col("mandantid").isNotNull() & F.col("age_group").isNotNull()))


def band_tenant_cross(enriched: DataFrame, digits: int | None = 1) -> DataFrame:
    """Contracts per tenant x band with % within tenant."""
    c = enriched.groupBy("mandantid", "age_group").agg(F.count(F.lit(1)).alias("n"))
    return c.withColumn("percentage", percent_of_total("n", ["mandantid"], digits))


def volatility_by_tenant_band(volatility: DataFrame, enriched: DataFrame, min_contracts: int = 2,
                              digits: int | None = 3) -> DataFrame:
    """D3: mean volatility per tenant x band for cells with >= ``min_contracts`` rows."""
    j = volatility.select("contractid", "volatility").join(
        enriched.select("contractid", "mandantid", "age_group"), "contractid")
    return (j.groupBy("mandantid", "age_group").agg(
                F.count(F.lit(1)).alias("contracts"),
                rnd(F.avg("volatility"), digits).alias("mean_volatility"))
            .where(F.col("contracts") >= min_contracts))


def leader(summary: DataFrame, label: str, count: str, dimension: str, order=None) -> DataFrame:
    """Arg-max of ``count`` with its share of the total.

    Ties go to the first label in ``order`` (default: the smallest label), e.g. band order
    for age bands. ``summary`` is an aggregated table (bands or tenants), so the
    unpartitioned ranking window runs over a handful of rows.
    """
    tot = summary.agg(F.sum(count).alias("_t"))
    w = Window.orderBy(F.col(count).desc(), order if order is not None else F.col(label).asc())
    best = summary.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") == 1)
    return one_row(best, tot).select(
        F.lit(dimension).alias("dimension"),
        F.col(label).cast("string").alias("leader"),
        F.col(count).cast("long").alias("count"),
        F.round(F.try_divide(100.0 * F.col(count), F.col("_t")), 1).alias("percentage"),
    )


def weighted_mean_age(age_summary: DataFrame, digits: int | None = 1) -> DataFrame:
    """Mean of band mean ages weighted by band counts."""
    return age_summary.agg(rnd(F.try_divide(F.sum(F.col("mean_age") * F.col("count")), F.sum("count")), digits)
                           .alias("weighted_mean_age"))


def risk_share(volatility: DataFrame, digits: int | None = 1) -> DataFrame:
    """Contracts in the high volatility classes, share, mean volatility."""
    hi = F.col("volatility_class").isin(*HIGH_CLASSES)
    return volatility.agg(
        F.count_if(hi).cast("long").alias("high_volatility_contracts"),
        F.count(F.lit(1)).alias("contracts"),
        rnd(F.try_divide(100.0 * F.count_if(hi), F.count(F.lit(1))), digits).alias("high_volatility_percent"),
        F.round(F.avg("volatility"), 2).alias("mean_volatility"),
    )


def sensitivity_share(sensitivity: DataFrame, digits: int | None = 1) -> DataFrame:
    """Contracts in the high sensitivity classes, share, mean |r|."""
    hi = F.col("sensitivity_class").isin(*HIGH_CLASSES)
    return sensitivity.agg(
        F.count_if(hi).cast("long").alias("high_sensitivity_contracts"),
        F.count(F.lit(1)).alias("contracts"),
        rnd(F.try_divide(100.0 * F.count_if(hi), F.count(F.lit(1))), digits).alias("high_sensitivity_percent"),
        F.round(F.avg(F.abs("correlation")), 3).alias("mean_abs_correlation"),
    )


def coverage(contracts: DataFrame, customers: DataFrame, customers_with_age: DataFrame,
             series: DataFrame) -> DataFrame:
    """Contracts with a series, customers with an age, mean observations per contract."""
    s = series.agg(F.count(F.lit(1)).alias("series_rows"),
                   F.countDistinct("contractid").alias("contracts_with_series"))
    c = contracts.agg(F.count(F.lit(1)).alias("contracts"))
    k = customers.agg(F.count(F.lit(1)).alias("customers"))
    a = customers_with_age.agg(F.count(F.lit(1)).alias("customers_with_age"))
    return (one_row(s, c, k, a)
            .withColumn("mean_observations_per_contract",
                        F.round(F.try_divide(F.col("series_rows").cast("double"), F.col("contracts_with_series")), 1))
            .select("contracts", "contracts_with_series", "customers", "customers_with_age",
                    "mean_observations_per_contract"))
