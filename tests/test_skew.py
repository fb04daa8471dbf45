"""A third of all series rows on one contract: growth and volatility still equal the
row-level SQL (DuckDB) on the same skewed data."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from policy_analytics.operators import series
from policy_analytics.plans.timeseries import VOL, _growth_cte
from policy_analytics.sources import fixtures as fx

SF = "/root/testdata/sf0.01"


def skewed(spark):
    ts = fx.timeseries(spark, SF)
    hot = F.abs(F.hash("contractid", "date", "surrender_value")) % 3 == 0
    return ts.withColumn("contractid", F.when(hot, F.lit("VHOT")).otherwise(F.col("contractid")))


def duck(df):
    con = duckdb.connect()
    con.register("timeseries", df.toArrow())
    return con


def test_growth_and_volatility_with_a_hot_contract(spark):
    ts = skewed(spark)
    hot_rows = ts.where(F.col("contractid") == "VHOT").count()
    assert hot_rows > ts.count() / 4
    con = duck(ts)
    g_sql = con.execute("WITH " + _growth_cte() + " SELECT contractid, date, monthly_growth_rate FROM growth").df()
    g = series.calculate_monthly_growth(ts).select("contractid", "date", "monthly_growth_rate").toPandas()
    assert len(g) == len(g_sql)
    g = g.sort_values(["contractid", "date"]).reset_index(drop=True)
    g_sql = g_sql.sort_values(["contractid", "date"]).reset_index(drop=True)
    assert (g.contractid == g_sql.contractid).all()
    np.testing.assert_allclose(g.monthly_growth_rate, g_sql.monthly_growth_rate, rtol=1e-9)
    # the hot contract's window partition holds one row per distinct day, not one per row
    days = ts.where(F.col("contractid") == "VHOT").select("date").distinct().count()
    assert g[g.contractid == "VHOT"].shape[0] <= days < hot_rows
    v_sql = con.execute("WITH " + VOL + " SELECT contractid, volatility FROM vol").df()
    v = series.calculate_volatility(series.calculate_monthly_growth(ts)).select("contractid", "volatility").toPandas()
    m = v.merge(v_sql, on="contractid", suffixes=("", "_sql"))
    assert len(m) == len(v) == len(v_sql)
    np.testing.assert_allclose(m.volatility, m.volatility_sql, atol=1e-9)
