"""CSV with accounted rejects (S4) and JSON of every landed shape (S3)."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from policy_analytics.sources import io

SCHEMA = T.StructType([T.StructField("contract_id", T.StringType()), T.StructField("datum", T.DateType()),
                       T.StructField("amount", T.DoubleType())])


def _files(tmp_path, *texts, ext="csv"):
    for i, t in enumerate(texts):
        (tmp_path / f"f{i}.{ext}").write_text(t)
    return str(tmp_path)


def test_columns_are_read_by_name_and_rejects_keep_their_line(spark, tmp_path):
    path = _files(tmp_path, "amount,extra,contract_id,datum\n1.5,x,V1,2020-01-02\n,y,V2,2020-01-03\nn/a,x,V3,2020-01-04\n"
                            "2.5,x\n3.5,x,V5,2020-01-05,surplus\n4.5,x,V6,no date\n")
    df = io.read_csv(spark, path, SCHEMA, reject="line")
    assert df.columns == ["contract_id", "datum", "amount", "line"]
    good = {tuple(r)[:3] for r in df.where("line IS NULL").collect()}
    assert good == {("V1", dt.date(2020, 1, 2), 1.5), ("V2", dt.date(2020, 1, 3), None)}
    assert {r.line for r in df.where("line IS NOT NULL").collect()} == {
        "n/a,x,V3,2020-01-04", "2.5,x", "3.5,x,V5,2020-01-05,surplus", "4.5,x,V6,no date"}
    assert [tuple(r) for r in io.intake_log({"t": (df, "line")}).collect()] == [("t", 6, 2, 4)]
    # pruning must not hide a bad line
    assert df.where("line IS NOT NULL").select("contract_id").count() == 4


def test_without_reject_column_a_bad_line_fails(spark, tmp_path):
    path = _files(tmp_path, "contract_id,datum,amount\nV1,2020-01-02,1\nV2,2020-01-02,n/a\n")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        io.read_table(spark, path, "csv", SCHEMA).select("contract_id").collect()


def test_headers_are_checked(spark, tmp_path):
    path = _files(tmp_path, "contract_id,amount\nV1,1\n")
    with pytest.raises(ValueError, match="datum"):
        io.read_csv(spark, path, SCHEMA)


def test_files_with_different_headers_fail(spark, tmp_path):
    path = _files(tmp_path, "contract_id,datum,amount\nV1,2020-01-02,1\n", "datum,contract_id,amount\n2020-01-02,V2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        io.read_csv(spark, path, SCHEMA, reject="line").collect()


def test_header_only_csv_is_empty(spark, tmp_path):
    df = io.read_csv(spark, _files(tmp_path, "contract_id,datum,amount\n"), SCHEMA, reject="line")
    assert df.count() == 0
    assert [tuple(r) for r in io.intake_log({"t": (df, "line")}).collect()] == [("t", 0, 0, 0)]


LINES = ['{"contract_id":"V1","datum":"2020-01-01","rueckkaufswert":12.5}',
         '[{"Contract ID":"V2","DATE":"x","Value":"3"},5,"six",null]',
         '{"a":{"contract_id":"V3"},"b":{"contract_id":"V4","extra":[1],"value":{"q":1}},"c":8}',
         '{"contract_id":"V5","tags":[1,2],"datum":null}',
         '7.25', 'null', '[]', '{}', '', 'true']
WANT = {("V1", "2020-01-01", "12.5"), ("V2", "x", "3"), (None, None, "5"), (None, None, "six"), ("V3", None, None),
        ("V4", None, '{"q":1}'), (None, None, "8"), ("V5", None, None), (None, None, "7.25"), (None, None, "true")}


def _rows(df):
    return [(r.contractid, r.date, r.surrender_value) for r in df.collect()]


def test_every_shape_gives_rows(spark, tmp_path):
    path = _files(tmp_path, "\n".join(LINES), ext="json")
    got = _rows(io.read_json_shapes(spark, path))
    assert len(got) == len(WANT) and set(got) == WANT


def test_malformed_lines_are_kept_or_fail(spark, tmp_path):
    bad = ['{"contract_id":', "[[1,2]]", "[1,"]
    path = _files(tmp_path, "\n".join([*LINES, *bad]), ext="json")
    df = io.read_json_shapes(spark, path, corrupt="line")
    assert {r.line for r in df.where("line IS NOT NULL").collect()} == set(bad)
    assert set(_rows(df.where("line IS NULL"))) == WANT
    with pytest.raises(Exception, match="malformed JSON"):
        io.read_json_shapes(spark, path).collect()


def test_two_fields_of_one_column_fail(spark, tmp_path):
    path = _files(tmp_path, '{"contract_id":"V1","datum":"a","date":"b"}', ext="json")
    with pytest.raises(Exception, match="several fields mean 'date'"):
        io.read_json_shapes(spark, path).collect()


def test_whole_files_and_other_tables(spark, tmp_path):
    path = _files(tmp_path, '[\n {"Customer ID": "K1",\n  "dob": "1950-01-01"},\n {"customerid": "K2"}\n]', ext="json")
    df = io.read_json_shapes(spark, path, "customers", whole_file=True)
    assert {(r.customerid, r.birthdate, r.value) for r in df.collect()} == {("K1", "1950-01-01", None), ("K2", None, None)}


def test_documents_are_taken_apart_once(spark, tmp_path):
    """No step after the parsing goes back to VARIANTs or their schemas: that was most of the time of the intake."""
    path = _files(tmp_path, "\n".join(LINES), ext="json")
    plan = io.read_json_shapes(spark, path, corrupt="line")._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Generate explode")]
    assert "variant" not in above.lower() and "schema_of_variant" not in plan.lower()


def test_names_that_mean_nothing_may_repeat(spark, tmp_path):
    path = _files(tmp_path, '{"contract_id":"V1","a":1,"b":2,"Surrender  VALUE-":{"q":[1,null]},"__datum":"x"}\n'
                            '{"k":{"a":1,"A":2},"m":[1],"n":null}\n{"Contract-ID":true,"contractid":"V2"}', ext="json")
    df = io.read_json_shapes(spark, path, corrupt="line")
    got = df.where("contractid IS NULL OR contractid <> 'x'")
    with pytest.raises(Exception, match="several fields mean 'contractid'"):
        got.collect()
    (tmp_path / "f0.json").write_text('{"contract_id":"V1","a":1,"b":2,"Surrender  VALUE-":{"q":[1,null]},"__datum":"x"}\n'
                                      '{"k":{"a":1,"A":2},"m":[1],"n":null}')
    rows = io.read_json_shapes(spark, path, corrupt="line").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([("V1", '{"q":[1,null]}', None, None), (None, None, None, None),
                                                        (None, None, None, '{"k":{"a":1,"A":2},"m":[1],"n":null}')], key=str)
