"""Age bands (A1-A6): boundaries and summaries."""

import datetime as dt

from policy_analytics.functions.stats import bin_left_closed
from policy_analytics.operators import age

AS_OF = dt.date(2024, 12, 31)


def test_band_boundaries(spark):
    df = spark.createDataFrame([(a,) for a in (29.9, 30.0, 49.9, 50.0, -0.1, 0.0)], "age double")
    got = [r[0] for r in df.select(bin_left_closed("age", age.band_breaks((30, 50)), age.DEFAULT_LABELS)).collect()]
    assert got == ["<30", "30-50", "30-50", ">50", None, "<30"]


def test_age_rounding_and_summary(spark):
    births = [dt.date(1990, 5, 15), dt.date(1985, 12, 1), dt.date(1975, 3, 20), None, dt.date(2000, 1, 1)]
    df = spark.createDataFrame([(f"K{i}", b) for i, b in enumerate(births)], "customerid string, birthdate date")
    c = age.classify_age_groups(df, AS_OF)
    ages = {r.customerid: r.age for r in c.collect()}
    assert ages["K0"] == round((AS_OF - births[0]).days / 365.25, 1)
    assert c.count() == 4
    s = {r.age_group: r for r in age.create_age_summary(c).collect()}
    assert sum(r["count"] for r in s.values()) == 4
    assert abs(sum(r.percentage for r in s.values()) - 100) < 0.2
    dist = age.age_distribution(c).collect()
    assert sorted(r.age_group for r in dist) == sorted(age.DEFAULT_LABELS)
    assert sum(r.customers for r in dist) == 4


def test_custom_bands_need_matching_labels(spark):
    df = spark.createDataFrame([("K1", dt.date(1990, 1, 1))], "customerid string, birthdate date")
    try:
        age.classify_age_groups(df, AS_OF, (25, 40, 60), ("a", "b"))
    except ValueError:
        return
    raise AssertionError("expected ValueError")


def test_unusable_birthdates_are_errors(spark):
    import pytest
    as_of = dt.date(2024, 12, 31)
    text = spark.createDataFrame([("K1", "1950-01-01")], "customerid string, birthdate string")
    with pytest.raises(TypeError, match="birthdate must be a date"):
        age.classify_age_groups(text, as_of)
    schema = "customerid string, birthdate date"
    none = spark.createDataFrame([("K1", None), ("K2", None)], schema)
    with pytest.raises(Exception, match="no customer has a valid birthdate"):
        age.classify_age_groups(none, as_of).collect()
    assert age.classify_age_groups(spark.createDataFrame([], schema), as_of).collect() == []
    some = spark.createDataFrame([("K1", None), ("K2", dt.date(1950, 1, 1))], schema)
    assert [r.customerid for r in age.classify_age_groups(some, as_of).collect()] == ["K2"]
