"""Snapshot store round trips."""

import datetime as dt

from pyspark.sql import functions as F

from policy_analytics.operators import clean
from policy_analytics.sources import fixtures as fx
from policy_analytics.sources import store
from conftest import SMOKE


def test_publish_list_load(spark):
    raw = {n: fx.RAW_VIEWS[n](spark, SMOKE) for n in store.TABLES}
    data, logs = clean.clean_all(raw, fx.AS_OF)
    root = store.new_store_root(spark, "test-store")
    now = dt.datetime(2024, 1, 2, 3, 4, 5)
    res = store.publish(data, logs, root, now=now)
    assert res["success"] and res["version_id"] == "v20240102_030405"
    assert store.latest_version(spark, root) == res["version_id"]
    loaded = store.load_version(spark, root, res["version_id"])
    for t in store.TABLES:
        assert loaded[t].exceptAll(data[t]).count() == 0 and data[t].exceptAll(loaded[t]).count() == 0
        assert res["row_counts"][t] == data[t].count()
    assert store.load_version(spark, root, "v_unknown") is None
    # same id again: the write fails and no second metadata row appears
    again = store.publish(data, logs, root, version_id=res["version_id"], now=now)
    assert not again["success"]
    assert store.list_versions(spark, root).count() == 1
    v = store.verify_store(spark, root).first()
    assert (v.tables, v.versions, v.ok) == (3, 1, True)
    inv = store.table_inventory(spark, root).where(F.col("table_name") == "timeseries").first()
    assert inv.rows == res["row_counts"]["timeseries"]


def test_whole_file_json_shapes(spark):
    import json
    import os

    from policy_analytics.session import shared_dir
    from policy_analytics.sources import io
    base = shared_dir(spark, f"json-shapes/{store.uuid.uuid4().hex}")
    recs = [{"contract_id": "V1", "datum": "2020-01-01", "rueckkaufswert": "EUR 1.00"},
            {"contract_id": "V2", "datum": "2020-02-01", "rueckkaufswert": None}]
    os.makedirs(f"{base}/array")
    os.makedirs(f"{base}/keyed")
    with open(f"{base}/array/a.json", "w") as f:
        json.dump(recs, f, indent=2)
    with open(f"{base}/keyed/k.json", "w") as f:
        json.dump({"r1": recs[0], "r2": recs[1]}, f, indent=2)
    a = io.read_series_json(spark, f"{base}/array", whole_file=True)
    k = io.read_series_json(spark, f"{base}/keyed", keyed=True, whole_file=True)
    exp = {(r["contract_id"], r["datum"], r["rueckkaufswert"]) for r in recs}
    assert {tuple(r) for r in a.collect()} == exp
    assert {tuple(r) for r in k.collect()} == exp
