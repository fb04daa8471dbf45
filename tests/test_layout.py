"""Range-clustered snapshots (S20), staged publishing (S9-S11) and verification by content."""

import datetime as dt
import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from policy_analytics.operators import clean
from policy_analytics.sources import fixtures as fx
from policy_analytics.sources import layout, store
from conftest import SMOKE

SERIES = "contractid string, date date, surrender_value double"


def series(n, hot_share, keys=300, seed=1):
    rng = random.Random(seed)
    day = dt.date(2000, 1, 1)
    return [("V7" if rng.random() < hot_share else f"V{rng.randrange(keys)}", day + dt.timedelta(rng.randrange(3000)), float(i))
            for i in range(n)]


@pytest.fixture(scope="module")
def snapshot(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layout"))
    df = spark.createDataFrame(series(20000, 0.35), SERIES).repartition(5)
    assert store.publish({"timeseries": df}, None, root, version_id="v1", rows_per_file=1000)["success"]
    return root, df


def test_lookup_opens_a_fraction_of_the_files(spark, snapshot):
    root, df = snapshot
    index = spark.read.schema(layout.INDEX_SCHEMA).parquet(f"{root}/file_index/timeseries/version_id=v1").collect()
    assert len(index) >= 18 and sum(r["rows"] for r in index) == 20000
    assert max(r["rows"] for r in index) < 2500                          # the hot key is split
    got = store.lookup(spark, root, "v1", "timeseries", ["V12", "V250"])
    assert 1 <= len(got.inputFiles()) <= 4
    want = df.where(F.col("contractid").isin("V12", "V250"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty() and not got.isEmpty()
    assert "PushedFilters: [In(contractid, [V12,V250])]" in got._jdf.queryExecution().executedPlan().toString()


def test_hot_key_is_split_by_day(spark, snapshot):
    root, df = snapshot
    hot = store.lookup(spark, root, "v1", "timeseries", ["V7"])
    days = (dt.date(2003, 1, 1), dt.date(2003, 6, 30))
    some = store.lookup(spark, root, "v1", "timeseries", ["V7"], days)
    assert len(hot.inputFiles()) >= 6 and len(some.inputFiles()) <= 3
    want = df.where((F.col("contractid") == "V7") & F.col("date").between(*days))
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, want.collect()))


def test_lookup_of_nothing(spark, snapshot):
    root, _ = snapshot
    assert store.lookup(spark, root, "v9", "timeseries", ["V1"]) is None
    assert store.lookup(spark, root, "v1", "customers", ["K1"]) is None
    for keys in ([], ["A0"], ["V"], ["it's"]):
        got = store.lookup(spark, root, "v1", "timeseries", keys)
        assert got.columns == ["contractid", "date", "surrender_value"] and got.isEmpty()
    with pytest.raises(ValueError):
        store.lookup(spark, root, "v1", "timeseries", [str(i) for i in range(store.MAX_LOOKUP_KEYS + 1)])


@pytest.mark.parametrize("rows", [[], [(None, None, 1.0)] * 3, [("V1", None, 1.0)] * 50, [("Vé", dt.date(2000, 1, 1), 1.0), ("V€uro", None, 2.0)] * 20])
def test_odd_tables_keep_all_rows(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, SERIES)
    out = layout.by_range(df, ("contractid", "date"), rows_per_file=5)
    assert sorted(map(str, out.collect())) == sorted(map(str, df.collect()))


def test_binary_search_counts_the_boundaries(spark):
    keys = [f"V{i}" for i in random.Random(3).sample(range(5000), 400)]
    df = spark.createDataFrame([(k, dt.date(2001, 1, 1) + dt.timedelta(i)) for i, k in enumerate(keys)], "contractid string, date date")
    width, cuts = layout.boundaries(df, ("contractid", "date"), 23)
    assert cuts == sorted(cuts) and len(cuts) >= 15
    got = df.select("contractid", "date", layout.file_number(("contractid", "date"), width, cuts).alias("n")).collect()
    for r in got:
        here = (r["contractid"].encode()[:width], (r["date"] - dt.date(1970, 1, 1)).days)
        assert r["n"] == sum(c <= here for c in cuts)


def test_verification_finds_altered_removed_and_added_files(spark, tmp_path):
    df = spark.createDataFrame(series(3000, 0.2), SERIES)
    for what in ("sound", "removed", "altered", "added", "broken"):
        root = str(tmp_path / what)
        assert store.publish({"timeseries": df}, None, root, version_id="v1", rows_per_file=500)["success"]
        files = sorted(glob.glob(f"{root}/tables/timeseries/version_id=v1/part-*.parquet"))
        if what == "removed":
            os.rename(files[1], str(tmp_path / "gone.parquet"))
        elif what == "altered":                         # same rows and ids, one value changed
            changed = spark.read.schema(SERIES).parquet(files[0]).withColumn(
                "surrender_value", F.col("surrender_value") + F.when(F.rand(1) < 0.01, 1.0).otherwise(0.0))
            changed.coalesce(1).write.parquet(str(tmp_path / "changed"))
            os.replace(glob.glob(str(tmp_path / "changed" / "part-*.parquet"))[0], files[0])
        elif what == "added":
            df.limit(3).coalesce(1).write.mode("append").parquet(os.path.dirname(files[0]))
        elif what == "broken":
            with open(files[0], "wb") as f:
                f.write(b"no parquet")
        for crc in glob.glob(f"{os.path.dirname(files[0])}/.*.crc"):
            os.rename(crc, str(tmp_path / (what + os.path.basename(crc))))
        r = store.verify_version(spark, root, "v1").first()
        assert r["ok"] is (what == "sound"), what
        assert store.verify_store(spark, root).first()["ok"] is (what == "sound")
    assert store.verify_version(spark, str(tmp_path / "sound"), "v0") is None


def test_staging_gives_the_same_tables_and_log(spark, tmp_path):
    for name, view in fx.RAW_VIEWS.items():
        raw = view(spark, SMOKE)
        plain = clean.clean_table(raw, name, fx.AS_OF)
        staged = clean.clean_table(raw, name, fx.AS_OF, staging=str(tmp_path / name))
        assert staged.data.exceptAll(plain.data).isEmpty() and plain.data.exceptAll(staged.data).isEmpty()
        assert staged.log.collect() == plain.log.collect()
        assert "l_partkey" not in staged.data._jdf.queryExecution().optimizedPlan().toString()     # raw is not read again


def test_distinct_rows_keeps_one_of_each(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b"]), rng.choice([None, 1, 2, 3]), float(rng.randrange(40))) for _ in range(3000)]
    rows += [(f"once{i}", i, 0.5) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, n int, v double")
    for bits in (1 << 23, 64):                          # 64: nearly every bit is set
        monkeypatch.setattr(clean, "TWIN_BITS", bits)
        got = clean.distinct_rows(df).collect()
        assert len(got) == len(set(rows)) and set(map(tuple, got)) == set(rows)
    assert clean.distinct_rows(df.where("false")).count() == 0


def test_log_of_a_version_is_read_back(spark, tmp_path):
    raw = {"customers": fx.raw_customers(spark, SMOKE)}
    data, results = clean.clean_all_results(raw, fx.AS_OF, staging=str(tmp_path / "staging"))
    res = store.publish(data, lambda counts: clean.full_logs(results, counts), str(tmp_path / "s"), version_id="v1")
    assert res["success"], res
    row = store.load_log(spark, str(tmp_path / "s"), "v1").first()
    log = json.loads(row["log_json"])
    assert row["table_type"] == "customers" and log["final_rows"] == res["row_counts"]["customers"]
    assert store.load_log(spark, str(tmp_path / "s"), "v2") is None
