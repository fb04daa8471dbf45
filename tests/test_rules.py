"""Unit rows of the cleaning rules (C1-C12), including the reference's quirks."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from policy_analytics.functions import names, rules
from policy_analytics.operators import clean

AS_OF = dt.date(2024, 12, 31)


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


@pytest.mark.parametrize("raw,expected", [
    (" Contract ID ", "contract_id"), ("Birth--Date!", "birth_date"), ("_x_", "_x"), ("A__B__", "a_b")])
def test_name_rule(raw, expected):
    assert names.normalise_name(raw) == expected


def test_alias_collision_raises(spark):
    df = spark.createDataFrame([(1, "2000-01-01", "2000-01-01")], "customer_id int, dob string, birth_date string")
    with pytest.raises(ValueError):
        names.standardise_columns(df, "customers")


def test_contract_ids(spark):
    df = one_col(spark, ["V007", "V-0 12^", "v12", "V000", "", None, "V10", "(V5)"])
    got = [r[0] for r in df.select(rules.clean_contract_id("x")).collect()]
    assert got == ["V7", "V12", "12", None, None, None, "V10", "V5"]
    strict = [r[0] for r in df.select(rules.clean_contract_id("x", strict=True)).collect()]
    assert strict[2] is None


def test_tenants(spark):
    df = one_col(spark, ["LV 1", "LV-2", "LV21", "lv1", "XX", None, "LV2", "LV12"])
    got = [r[0] for r in df.select(rules.clean_tenant("x")).collect()]
    assert got == ["LV1", "LV2", "LV1", None, None, None, "LV2", "LV1"]
    assert df.select(rules.clean_tenant("x", casefold=True)).collect()[3][0] == "LV1"


def test_birth_dates(spark):
    vals = ["1990-05-15", "15.05.1990", "15/05/1990", "1899-12-31", "1900-01-01", "2024-12-31",
            "2025-01-01", "2020-02-30", "NULL", None, "1990-05-15 10:00:00"]
    df = one_col(spark, vals)
    parsed = rules.parse_date_multi("x", T.StringType())
    got = [r[0] for r in df.select(rules.within_dates(parsed, rules.MIN_BIRTHDATE, AS_OF)).collect()]
    d = dt.date(1990, 5, 15)
    assert got == [d, d, d, None, dt.date(1900, 1, 1), AS_OF, None, None, None, None, d]


def test_amounts(spark):
    df = one_col(spark, ["EUR 12.50", "-1", "0", "1.234,56", "n/a", None])
    got = [r[0] for r in df.select(rules.parse_amount("x", T.StringType())).collect()]
    assert got == [12.5, None, 0.0, 1.23456, None, None]
    num = spark.createDataFrame([(100000.0,), (-3.0,)], "x double")
    assert [r[0] for r in num.select(rules.parse_amount("x", T.DoubleType())).collect()] == [100000.0, None]
    dc = [r[0] for r in df.select(rules.parse_amount("x", T.StringType(), decimal_comma=True)).collect()]
    assert dc[3] == 1234.56


def test_mode_imputation_tie_and_all_null(spark):
    rows = [("V1", "K1", "LV2"), ("V2", "K2", "LV1"), ("V3", "K3", None), (None, "K4", "LV1")]
    df = spark.createDataFrame(rows, "contract_id string, customer_id string, mandant_id string")
    res = clean.clean_table(df, "contracts", AS_OF)
    got = {r.contractid: r.mandantid for r in res.data.collect()}
    assert got == {"V1": "LV2", "V2": "LV1", "V3": "LV1"}           # tie -> alphabetically first
    log = res.log.first()
    assert (log.null_key_rows, log.imputed_values, log.final_rows) == (1, 1, 3)
    none = spark.createDataFrame([("V1", "K1", None)], "contract_id string, customer_id string, mandant_id string")
    assert clean.clean_table(none, "contracts", AS_OF).data.first().mandantid is None


def test_duplicates_after_cleaning_nulls_equal(spark):
    rows = [("V01", "K1", None), ("V1", "K1", None), ("V1", "K01", None), ("V2", "K2", "LV2")]
    df = spark.createDataFrame(rows, "contractid string, customerid string, mandantid string")
    res = clean.clean_table(df, "contracts", AS_OF, clean.Policy(impute_tenant=False))
    assert res.data.count() == 2
    log = res.log.first()
    assert log.duplicates_removed == 2 and log.original_rows == 4 and log.rows_retained_percent == 50.0
