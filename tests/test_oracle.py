"""Every registered query equals its DuckDB oracle SQL on the smoke tables."""

import math
import os
import sys

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SMOKE

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from oracle_check import compare  # noqa: E402
from policy_analytics.plans import registry  # noqa: E402
from policy_analytics.sources.fixtures import TABLES  # noqa: E402

registry.load_all()
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SMOKE}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    registry.load_all()
    assert set(registry.QUERIES) == set(registry.ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    s = registry.QUERIES[name](spark, SMOKE).toPandas()
    d = con.execute(ORACLES[name]).df()
    status, msg = compare(s, d)
    assert status in ("OK", "APPROX"), f"{name}: {status} {msg}"


def test_entry_smoke(spark):
    rows = E.entry(spark).collect()
    assert len(rows) >= 1 and not any(math.isnan(r.percentage) for r in rows)
