"""Nothing is lost without a word: versions, malformed input, NULL keys, absent rate data."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from policy_analytics.functions import rules
from policy_analytics.operators import quality, rates
from policy_analytics.sources import io, store

AS_OF = dt.date(2024, 6, 1)


def test_each_version_keeps_its_columns_and_only_listed_ones_count(spark, tmp_path):
    root = str(tmp_path / "s")
    one = spark.createDataFrame([("V1", 1.0)], "contractid string, surrender_value double")
    for v, df in (("v1", one), ("v2", one.withColumn("extra", F.lit("x")))):
        assert store.publish({"contracts": df}, None, root, version_id=v)["success"]
    one.write.parquet(f"{root}/tables/contracts/version_id=v3")         # never committed
    assert store.load_version(spark, root, "v1")["contracts"].columns == ["contractid", "surrender_value"]
    assert store.load_version(spark, root, "v2")["contracts"].columns == ["contractid", "surrender_value", "extra"]
    rows = store.table_inventory(spark, root).collect()
    assert sorted((r["table_name"], r["version_id"], r["rows"]) for r in rows) == [("contracts", "v1", 1), ("contracts", "v2", 1)]
    assert store.table_inventory(spark, str(tmp_path / "none")).count() == 0


def test_is_listed_raises_when_the_listing_cannot_be_read(spark, tmp_path):
    assert store.is_listed(spark, str(tmp_path / "none"), "v1") is False
    bad = tmp_path / "bad" / "data_versions"
    bad.mkdir(parents=True)
    (bad / "part-0.parquet").write_text("this is no parquet file at all")
    with pytest.raises(Exception):
        store.is_listed(spark, str(tmp_path / "bad"), "v1")


@pytest.mark.parametrize("keyed", [False, True])
def test_malformed_json_is_kept_or_fails(spark, tmp_path, keyed):
    fields = [f.name for f in io.SERIES_RECORD.fields]
    sound = '{"%s": "a"}' % fields[0]
    (tmp_path / "x.json").write_text(('{"1": %s}' % sound if keyed else sound) + "\n{broken\n")
    rows = io.read_series_json(spark, str(tmp_path / "x.json"), keyed=keyed, corrupt="bad").cache().collect()
    assert [r["bad"] for r in rows if r["bad"]] == ["{broken"] and len(rows) == 2
    with pytest.raises(Exception):
        io.read_series_json(spark, str(tmp_path / "x.json"), keyed=keyed).collect()


def test_null_keys_are_groups(spark):
    df = spark.createDataFrame([(None, float(i)) for i in range(20)] + [("a", 1.0), ("a", 3.0), (None, 500.0)], "k string, v double")
    got = {r["k"]: (r["n"], r["median"]) for r in rates.numeric_stats(df, "v", "k").collect()}
    assert got == {None: (21, 10.0), "a": (2, 2.0)}
    assert {r["k"]: r["outliers"] for r in rates.outliers(df, "v", "k").collect()} == {None: 1, "a": None}


def test_absent_empty_and_incomplete_rate_tables(spark):
    full = spark.createDataFrame([], "date date, interest_rate double, year_month string")
    for df in (None, full):
        r = rates.rate_quality(df, AS_OF, spark=spark).first()
        assert (r["issues"], r["status"]) == (999, "no_data")
    bare = spark.createDataFrame([("x",)], "note string")
    r = rates.rate_quality(bare, AS_OF).first()
    assert (r["issues"], r["missing_columns"], r["status"]) == (3, 3, "minor")
    assert rates.date_checks(bare, AS_OF).count() == rates.negatives(bare).count() == rates.constant_or_empty(bare).count() == 0


def test_recency_without_a_date_is_null(spark):
    df = spark.createDataFrame([("a", None), ("b", AS_OF)], "k string, date date")
    assert {r["k"]: r["recency"] for r in rates.recency(df, AS_OF, "k").collect()} == {"a": None, "b": "fresh"}


def test_signed_amount_reads_decimal_commas(spark):
    df = spark.createDataFrame([("-1.234.567,00",), ("1.234,56",)], "t string")
    got = [r[0] for r in df.select(rules.signed_amount("t", decimal_comma=True)).collect()]
    assert got == [-1234567.0, 1234.56]


def test_quality_total_and_absent_tables(spark):
    raw = spark.createDataFrame([("K1", None), ("K1", None)], "customerid string, birthdate date")
    clean = {"contracts": None, "customers": raw, "timeseries": None}
    got = quality.quality_summary({"contracts": None, "customers": raw, "timeseries": None}, clean, dt.date(2024, 12, 31))
    rows = {r["table_name"]: r["issues_found"] for r in got.collect()}
    assert (rows["contracts"], rows["timeseries"], rows["referential_integrity"]) == (999, 999, 1)
    assert quality.total_issues(got).first()["total_issues"] == sum(rows.values())
    assert quality.quality_summary({}, {}, dt.date(2024, 12, 31)).count() == 4
