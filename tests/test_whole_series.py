"""The per-contract series checks and the growth queries read every ``lineitem`` row."""

import datetime as dt
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import compare  # noqa: E402
from policy_analytics.plans import registry  # noqa: E402

registry.load_all()
NAMES = ["contract_gaps", "contract_outliers", "contract_jumps", "contract_recency", "growth", "growth_stats", "growth_variant"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    # part keys 7 and 26 leave 7 when divided by 19, 3 and 32 leave 3 when divided by 29; some rows have no part key
    d = str(tmp_path_factory.mktemp("whole"))
    rows = [(i, p, i % 7 + 1, 3.0 * i, dt.date(1995, 1, 1) + dt.timedelta(days=40 * i + (p or 0)))
            for i in range(12) for p in (1, 3, 7, 26, 32, None)]
    schema = "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_shipdate date"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{d}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT *, 1.0 AS l_extendedprice FROM read_parquet('{d}/lineitem.parquet/*.parquet')")
    con.execute("CREATE TABLE part AS SELECT 1 AS p_partkey, 1 AS p_size")
    con.execute("CREATE TABLE customer AS SELECT 1 AS c_custkey")
    con.execute("CREATE TABLE orders AS SELECT DATE '1995-01-01' AS o_orderdate, 1.0 AS o_totalprice")
    return d, con


@pytest.mark.parametrize("name", NAMES)
def test_no_contract_is_left_out(spark, tables, name):
    d, con = tables
    got = registry.QUERIES[name](spark, d).toPandas()
    status, msg = compare(got, con.execute(registry.ORACLES[name]).df())
    assert status in ("OK", "APPROX"), msg
    if name == "growth_stats":
        assert got.contracts.tolist() == [6]
    else:
        assert set(got.contractid) == {"V1", "V7", "V26", "V100000003", "V100000032", "V"}
