"""Generated inputs: the Spark column rules equal a plain-Python model of the same rules."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from policy_analytics.functions import rules

ID_CHARS = "VKvk0123456789L-^() .,"
AMOUNT_CHARS = "0123456789.-, EURn/a"


def model_id(s, letter):
    if s is None:
        return None
    t = re.sub(f"[^{letter}0-9]", "", s)
    t = re.sub(f"^{letter}0*", letter, t)
    return t if len(t) >= 2 else None


def model_tenant(s):
    if s is None:
        return None
    t = re.sub("[^LV12]", "", s).upper()
    if re.search("LV.*1", t):
        return "LV1"
    if re.search("LV.*2", t):
        return "LV2"
    return None


def model_amount(s):
    if s is None:
        return None
    t = re.sub(r"[^0-9.\-]", "", s)
    if not re.fullmatch(r"-?(\d+\.?\d*|\.\d+)", t):
        return None
    v = float(t)
    return v if v >= 0 else None


def _date(y, m, d):
    try:
        return dt.date(y, m, d)
    except ValueError:
        return None


def model_date(s):
    if s is None:
        return None
    s = s.strip()
    m = re.match(r"^(\d{4})-(\d{1,2})-(\d{1,2})", s)
    if m and _date(*map(int, m.groups())):
        return _date(*map(int, m.groups()))
    m = re.fullmatch(r"(\d{4})/(\d{1,2})/(\d{1,2})", s)
    if m and _date(*map(int, m.groups())):
        return _date(*map(int, m.groups()))
    for sep in (r"\.", "/"):
        m = re.fullmatch(rf"(\d{{1,2}}){sep}(\d{{1,2}}){sep}(\d{{4}})", s)
        if m:
            d, mo, y = map(int, m.groups())
            if _date(y, mo, d):
                return _date(y, mo, d)
    return None


texts = st.lists(st.one_of(st.none(), st.text(ID_CHARS, max_size=9)), min_size=1, max_size=150)


@settings(max_examples=4, deadline=None)
@given(texts)
def test_ids_and_tenants_match_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = df.select(rules.clean_contract_id("x").alias("v"), rules.clean_customer_id("x").alias("k"),
                    rules.clean_tenant("x").alias("t")).collect()
    for v, r in zip(values, got):
        assert (r.v, r.k, r.t) == (model_id(v, "V"), model_id(v, "K"), model_tenant(v)), v


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(AMOUNT_CHARS, max_size=10)), min_size=1, max_size=150))
def test_amounts_match_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(rules.parse_amount("x", T.StringType())).collect()]
    for v, g in zip(values, got):
        assert g == model_amount(v), v


@st.composite
def date_text(draw):
    y, m, d = draw(st.integers(1890, 2030)), draw(st.integers(1, 13)), draw(st.integers(1, 31))
    fmt = draw(st.sampled_from(["iso", "iso_t", "slash_ymd", "dot", "slash", "junk"]))
    pad = draw(st.booleans())
    mm, dd = (f"{m:02d}", f"{d:02d}") if pad else (str(m), str(d))
    return {"iso": f"{y}-{mm}-{dd}", "iso_t": f"{y}-{mm}-{dd} 10:00:00", "slash_ymd": f"{y}/{mm}/{dd}",
            "dot": f"{dd}.{mm}.{y}", "slash": f"{dd}/{mm}/{y}", "junk": f"{dd}-{mm}.{y}"}[fmt]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(st.none(), date_text()), min_size=1, max_size=150))
def test_dates_match_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(rules.parse_date_multi("x", T.StringType())).collect()]
    for v, g in zip(values, got):
        assert g == model_date(v), v
