"""Stand-in policy tables derived from the driver's TPC-H-ish parquet tables.

These only give rows in the schemas the jobs expect (contracts, customers, contract
value series, daily interest rates, and their dirty raw forms); they do none of the
jobs' work. Every registered query reads them, so its work grows with the tables.
The same views are written in DuckDB SQL in :mod:`policy_analytics.plans.oracle`.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the analysis date used by every registered query (never the wall clock).
AS_OF = dt.date(2024, 12, 31)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c) -> F.Column:
    return c.cast("string")


# ----------------------------------------------------------------- clean views

def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One contract per part; some name no customer, some one that does not exist."""
    p = table(spark, sf_dir, "part")
    return p.select(
        F.concat(F.lit("V"), _s(p.p_partkey)).alias("contractid"),
        F.when(p.p_partkey % 23 == 5, F.lit(None).cast("string"))
         .when(p.p_partkey % 31 == 9, F.concat(F.lit("K"), _s(p.p_partkey + 100000000)))
         .otherwise(F.concat(F.lit("K"), _s(F.expr("p_partkey * 3 div 4")))).alias("customerid"),
        F.when(p.p_size % 3 == 0, F.lit("LV2")).otherwise(F.lit("LV1")).alias("mandantid"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("K"), _s(c.c_custkey)).alias("customerid"),
        F.when(c.c_custkey % 17 == 0, F.lit(None).cast("date"))
         .otherwise(F.date_add(F.lit(dt.date(1930, 1, 1)), ((c.c_custkey * 7919) % 27000).cast("int")))
         .alias("birthdate"),
    )


def timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series of most contracts, and some of contracts that do not exist."""
    return _series(table(spark, sf_dir, "lineitem").where(F.col("l_partkey") % 19 != 7))


def whole_timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The series of every ``lineitem`` row; without a part key the contract is ``V``, as ``concat`` gives in the SQL."""
    return _series(table(spark, sf_dir, "lineitem"))


def _series(li: DataFrame) -> DataFrame:
    d = li.l_shipdate.cast("date")
    return li.select(
        F.concat_ws("", F.lit("V"), _s(li.l_partkey + F.when(li.l_partkey % 29 == 3, 100000000).otherwise(0))).alias("contractid"),
        d.alias("date"),
        F.when((li.l_linenumber == 7) & (li.l_quantity < 5), F.lit(None).cast("double"))
         .otherwise(10000 + 4 * F.datediff(d, F.lit(dt.date(1995, 1, 1))) + 2 * li.l_quantity)
         .alias("surrender_value"),
    )


def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily rate series ``(date, interest_rate)``; one row per order date."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy(o.o_orderdate.cast("date").alias("date"))
             .agg((F.avg("o_totalprice") / 100000 - 1).alias("interest_rate")))


def daily_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed daily market series ``(date, close)`` the rate intake reads."""
    return daily_rates(spark, sf_dir).withColumnRenamed("interest_rate", "close")


# ----------------------------------------------------------------- dirty views

def raw_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").withColumn("k", _s(F.col("p_partkey")))
    k, pk, sz = F.col("k"), F.col("p_partkey"), F.col("p_size")
    dirty = p.select(
        F.when(pk % 44 == 4, F.lit(None).cast("string"))
         .when(pk % 11 == 0, F.concat(F.lit(" V-00"), k))
         .when(pk % 11 == 1, F.concat(F.lit("V0"), k, F.lit("^")))
         .when(pk % 11 == 2, F.concat(F.lit("(V"), k, F.lit(")")))
         .when(pk % 11 == 3, F.concat(F.lit("v"), k))
         .otherwise(F.concat(F.lit("V"), k)).alias("contract_id"),
        F.concat(F.when(pk % 13 == 0, F.lit("K00")).otherwise(F.lit("K")), _s(pk % 1200)).alias("customer_id"),
        F.when(sz % 7 == 0, F.lit("LV 1")).when(sz % 7 == 1, F.lit("LV2")).when(sz % 7 == 2, F.lit("lv1"))
         .when(sz % 7 == 3, F.lit(None).cast("string")).when(sz % 7 == 4, F.lit("LV-2"))
         .when(sz % 7 == 5, F.lit("LV21")).otherwise(F.lit("LV1")).alias("mandant_id"),
    )
    repeats = p.where(pk % 50 == 6).select(
        F.concat(F.lit("V"), k).alias("contract_id"),
        F.concat(F.lit("K"), _s(pk % 1200)).alias("customer_id"),
        F.lit("LV1").alias("mandant_id"),
    )
    return dirty.unionByName(repeats)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    ck = c.c_custkey
    d = F.date_add(F.lit(dt.date(1890, 1, 1)), ((ck * 7919) % 51000).cast("int"))
    y = _s(F.year(d))
    m = F.lpad(_s(F.month(d)), 2, "0")
    dd = F.lpad(_s(F.dayofmonth(d)), 2, "0")
    return c.select(
        F.when(ck % 97 == 0, F.lit(""))
         .otherwise(F.concat(F.when(ck % 10 == 0, F.lit("K-0")).otherwise(F.lit("K")), _s(ck)))
         .alias("customer_id"),
        F.when(ck % 17 == 0, F.lit(None).cast("string")).when(ck % 17 == 1, F.lit("NULL"))
         .when(ck % 3 == 0, F.concat(dd, F.lit("."), m, F.lit("."), y))
         .when(ck % 3 == 1, F.concat(dd, F.lit("/"), m, F.lit("/"), y))
         .otherwise(F.concat(y, F.lit("-"), m, F.lit("-"), dd)).alias("dob"),
    )


def raw_timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    ln, q = li.l_linenumber, li.l_quantity
    return li.select(
        F.when((ln == 7) & (q < 3), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("V"), _s(li.l_partkey))).alias("contract_id"),
        F.when((ln == 6) & (q < 3), F.lit("1985-01-01"))
         .otherwise(_s(li.l_shipdate.cast("date"))).alias("datum"),
        F.when((ln == 5) & (q < 3), F.lit("n/a")).when((ln == 4) & (q < 3), F.lit("-1.00"))
         .otherwise(F.concat(F.lit("EUR "), _s(li.l_extendedprice.cast("decimal(18,2)"))))
         .alias("rueckkaufswert"),
    )


CLEAN_VIEWS = {"contracts": contracts, "customers": customers, "timeseries": timeseries,
               "daily_rates": daily_rates}
RAW_VIEWS = {"contracts": raw_contracts, "customers": raw_customers, "timeseries": raw_timeseries}
