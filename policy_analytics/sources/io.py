"""Sources and sinks (S1-S7, S18, S19) on Spark's own readers and writers.

Single-machine formats of the reference (SQLite file, spreadsheet, HTTP download) are
landed as Parquet / CSV / JSON and read here with explicit schemas.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import rules
from ..functions.names import ALIASES, standardise_columns

SERIES_RECORD = T.StructType([
    T.StructField("contract_id", T.StringType()),
    T.StructField("datum", T.StringType()),
    T.StructField("rueckkaufswert", T.StringType()),
])


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None, **options) -> DataFrame:
    """Scan a landed table (``SELECT *``); CSV/JSON need a schema or a header.

    CSV with a schema goes through :func:`read_csv` and fails on a bad line.
    """
    if fmt == "csv" and schema is not None and str(options.get("header", "true")).lower() == "true":
        return read_csv(spark, path, schema, **options)
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        options.setdefault("header", "true")
    return r.options(**options).load(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, reject: str | None = None, **options) -> DataFrame:
    """CSV with a header, read by column name, no line lost and no value nulled unseen.

    The columns of ``schema`` may stand in any order in the files, among others, which are
    left out. A column that the header lacks is an error when the frame is built, and a file whose header
    differs from the first one's is an error when it is read. Lines with missing or surplus
    fields or unreadable values fail the read; with ``reject`` they are kept instead, with
    their text in a column of that name (null for sound lines). Empty fields are NULL, not bad.
    """
    options = {**options, "header": "true"}
    header = spark.read.options(**options).csv(path).columns          # reads the first line of one file
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path}: header {header} lacks {missing}")
    if reject is not None and reject in header:
        raise ValueError(f"{path}: column {reject!r} is in the header")
    types = {f.name: f.dataType for f in schema.fields}
    by_header = T.StructType([T.StructField(c, types.get(c, T.StringType())) for c in header])
    reader = spark.read.options(**options, enforceSchema="false", columnPruning="false")
    names = [f.name for f in schema.fields]
    # true for every row, and needs every declared column: the reader converts only what is needed,
    # and a bad value in a column that a query leaves out would pass
    read_whole = F.xxhash64(*names) >= F.lit(-(1 << 63))
    if reject is None:
        return reader.schema(by_header).option("mode", "FAILFAST").csv(path).where(read_whole).select(*names)
    kept = T.StructType([*by_header.fields, T.StructField(reject, T.StringType())])
    lines = reader.schema(kept).option("columnNameOfCorruptRecord", reject).csv(path)
    return lines.select(*names, F.when(read_whole, F.col(reject)).alias(reject))


def intake_log(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows read, accepted and rejected per landed table: ``name -> (frame, its reject column)``, one aggregate each."""
    parts = [df.agg(F.count(F.lit(1)).alias("lines"), F.count(F.when(F.col(c).isNull(), 1)).alias("accepted"),
                    F.count(c).alias("rejected")).select(F.lit(name).alias("source"), "lines", "accepted", "rejected")
             for name, (df, c) in tables.items()]
    return reduce(lambda x, y: x.unionByName(y), parts)


def typed_raw(df: DataFrame, table_type: str) -> DataFrame:
    """Reader typing of a raw table: standard names, dates and amounts typed, nothing validated.

    This is what the quality checks see: a loaded but uncleaned table (negative amounts and
    out-of-range dates stay in; unparseable text becomes NULL).
    """
    df, _ = standardise_columns(df, table_type)
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = {}
    if "birthdate" in df.columns:
        cols["birthdate"] = rules.parse_date_multi("birthdate", types["birthdate"])
    if "date" in df.columns:
        cols["date"] = rules.parse_date_iso("date", types["date"])
    if "surrender_value" in df.columns:
        t = types["surrender_value"]
        cols["surrender_value"] = (F.col("surrender_value").cast("double") if isinstance(t, T.NumericType)
                                   else F.regexp_replace(F.col("surrender_value").cast("string"), "[^0-9.-]", "")
                                   .try_cast("double"))
    return df.withColumns(cols) if cols else df


def read_series_json(spark: SparkSession, path: str, keyed: bool = False,
                     record: T.StructType = SERIES_RECORD, whole_file: bool = False,
                     corrupt: str | None = None) -> DataFrame:
    """S3: JSON series, either records or an object keyed by record id.

    * ``keyed=False``: JSON lines of records; with ``whole_file=True`` each file is one
      top-level array of records (``multiLine``).
    * ``keyed=True``: each line is ``{"<id>": {record}, ...}``; with ``whole_file=True`` each
      file is one such object. It is read as a map and the map values become rows
      (``explode(map_values)``).

    A whole-file JSON document cannot be split, so whole-file forms parallelise across
    files only; JSON lines split within files.

    Malformed JSON is never dropped: with ``corrupt`` its text is kept in a column of that
    name (null for sound records), without it the read fails.
    """
    if not keyed:
        reader = spark.read.option("multiLine", str(whole_file).lower())
        if corrupt is None:
            return reader.schema(record).option("mode", "FAILFAST").json(path)
        kept = T.StructType([*record.fields, T.StructField(corrupt, T.StringType())])
        return reader.schema(kept).option("columnNameOfCorruptRecord", corrupt).json(path)
    raw = spark.read.text(path, wholetext=whole_file)
    m = F.from_json("value", T.MapType(T.StringType(), record))
    bad = m.isNull() & (F.trim("value") != "")
    if corrupt is None:
        m = F.when(bad, F.raise_error(F.concat(F.lit("malformed JSON: "), F.substring("value", 1, 200)))
                   .cast(T.MapType(T.StringType(), record))).otherwise(m)
        return raw.select(F.explode(F.map_values(m)).alias("r")).select("r.*")
    return (raw.select(F.when(bad, F.col("value")).alias(corrupt), F.explode_outer(F.map_values(m)).alias("r"))
            .where(F.col("r").isNotNull() | F.col(corrupt).isNotNull()).select("r.*", corrupt))


def read_json_shapes(spark: SparkSession, path: str, table_type: str = "timeseries", whole_file: bool = False,
                     corrupt: str | None = None) -> DataFrame:
    """S3: JSON of any of the landed shapes, even mixed, as the standard columns of ``table_type`` (strings).

    Every line (with ``whole_file`` every file) is one JSON document, parsed as VARIANT:

    * an array: each element is a row;
    * an object with a known field name: one row;
    * any other object: keyed rows, each value a row;
    * a scalar, alone, as an element or under a key: a row with only the column ``value``, or
      what the alias table makes of it. ``null`` gives no row, an empty array or object neither.

    Field names follow C1 and C2 (``Contract_ID``, ``datum``, ...); unknown fields are left
    out, nested fields keep their JSON text. Two fields of one row that mean one column raise, as in C2.
    Malformed documents fail the read; with ``corrupt`` their text is kept in a column of that
    name (null for sound rows). An element that is itself an array is malformed; each counts.
    """
    known_names = ALIASES[table_type]
    scalar_column = known_names.get("value", "value")
    targets = {scalar_column: scalar_column, **known_names} if scalar_column not in known_names.values() else known_names
    columns = list(dict.fromkeys([*known_names.values(), scalar_column]))
    raw = spark.read.text(path, wholetext=whole_file).where(F.trim("value") != "")
    # all the query needs of a document is taken in one place: no step below goes back to the VARIANT
    doc = raw.select(F.col("value").alias("line"), F.try_parse_json("value").alias("doc"))
    doc = doc.withColumn("fields", _fields("doc"))
    known = F.exists(F.map_keys("fields"), lambda k: _target(k, known_names).isNotNull())
    elements = (F.when(F.col("doc").isNull(), F.array(_element(bad=F.lit(True))))
                .when(F.col("fields").isNotNull() & known, F.array(_element(fields=F.col("fields"))))
                .when(F.col("fields").isNotNull(), _elements(F.map_values(F.try_variant_get("doc", "$", "map<string,variant>"))))
                .otherwise(F.coalesce(_elements(F.try_variant_get("doc", "$", "array<variant>")),
                                      F.array(_element(text=F.try_variant_get("doc", "$", "string"))))))
    rows = doc.select("line", F.explode(elements).alias("e")).select("line", "e.*")
    rows = rows.where(F.col("bad") | F.col("fields").isNotNull() | F.col("text").isNotNull())      # JSON null gives no row
    rows = rows.withColumn("names", F.transform(F.map_keys("fields"), lambda k: _target(k, targets)))
    # only rows in which a name (or no known name) occurs twice are searched for a second field of a column
    rows = rows.select("line", "bad", "text", "names", F.map_values("fields").alias("values"),
                       (F.size(F.array_distinct("names")) < F.size("names")).alias("repeats"))
    out = []
    for c in columns:
        at = F.array_position("names", c).cast("int")
        more = F.col("repeats") & F.array_contains(F.slice("names", at + 1, F.size("names")), c)
        value = (F.when(at == 0, F.lit(None).cast("string"))
                 .when(more, F.raise_error(F.concat(F.lit(f"several fields mean {c!r}: "), F.substring("line", 1, 200))).cast("string"))
                 .otherwise(F.get("values", at - 1)))
        if c == scalar_column:
            value = F.when(F.col("names").isNotNull(), value).otherwise(F.col("text"))
        out.append(value.alias(c))
    bad = F.col("bad")
    if corrupt is None:
        stop = F.when(bad, F.raise_error(F.concat(F.lit("malformed JSON: "), F.substring("line", 1, 200))).cast("boolean"))
        return rows.where(F.coalesce(stop, F.lit(True))).select(*out)
    return rows.select(*out, F.when(bad, F.col("line")).alias(corrupt))


def _fields(v) -> Column:
    """The fields of a VARIANT object as text: scalars as they are, nested values as JSON, JSON null as NULL; NULL if it is no object."""
    return F.try_variant_get(v, "$", "map<string,string>")


def _element(fields=None, text=None, bad=None) -> Column:
    """One row to be: the fields of an object or the text of a scalar; ``bad``: malformed. Nothing of it: JSON null."""
    return F.struct((F.lit(None).cast("map<string,string>") if fields is None else fields).alias("fields"),
                    (F.lit(None).cast("string") if text is None else text).alias("text"),
                    (F.lit(False) if bad is None else bad).alias("bad"))


def _elements(variants: Column) -> Column:
    """The rows of an array of VARIANTs; an element that is itself an array is malformed."""
    def element(p):
        array = p["f"].isNull() & F.try_variant_get(p["v"], "$", "array<variant>").isNotNull()
        return _element(p["f"], F.when(p["f"].isNull() & ~array, F.try_variant_get(p["v"], "$", "string")), array)
    return F.transform(F.transform(variants, lambda v: F.struct(v.alias("v"), _fields(v).alias("f"))), element)


def _target(name: Column, targets: dict[str, str]) -> Column:
    """The standard column that a field name means, by C1 and C2; NULL for none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in targets.items() for x in kv]), _normalised(name))


def _normalised(name: Column) -> Column:
    """:func:`normalise_name` as a column."""
    return F.rtrim(F.regexp_replace(F.lower(F.trim(name)), "[^a-z0-9]+", "_"), F.lit("_"))


def write_series_json(df: DataFrame, path: str, keyed: bool = False, key: str = "row_id") -> None:
    """Write records as JSON lines (or keyed objects ``{"<key>": {record}}``)."""
    if not keyed:
        df.write.mode("overwrite").json(path)
        return
    rec = F.struct(*[F.col(c) for c in df.columns if c != key])
    (df.select(F.to_json(F.create_map(F.col(key).cast("string"), rec)).alias("value"))
       .write.mode("overwrite").text(path))


def write_csv(tables: dict[str, DataFrame | None], root: str) -> list[str]:
    """One CSV folder per non-null table (header row); returns the written names."""
    written = []
    for name, df in tables.items():
        if df is None:
            continue
        df.write.mode("overwrite").option("header", "true").csv(f"{root.rstrip('/')}/{name}")
        written.append(name)
    return written


def daily_rate_intake(landed: DataFrame, start: dt.date = dt.date(2020, 1, 1),
                      end: dt.date = dt.date(2024, 12, 31)) -> DataFrame:
    """Keep ``(date, close)``, drop NULL close, bound the dates to ``[start, end]``."""
    return (landed.select(F.col("date").cast("date").alias("date"), F.col("close").cast("double").alias("close"))
            .where(F.col("close").isNotNull() & F.col("date").between(F.lit(start), F.lit(end))))


def source_preview(df: DataFrame, name: str, n: int = 3) -> tuple[DataFrame, DataFrame]:
    """(one-row profile: columns, types, rows) and the first ``n`` rows."""
    prof = df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("source"), F.lit(", ".join(df.columns)).alias("columns"),
        F.lit(", ".join(t for _, t in df.dtypes)).alias("types"), "rows")
    return prof, df.limit(n)


def source_completeness(sources: dict[str, DataFrame | None]) -> DataFrame:
    """Per registered source whether it has rows; plus how many of them do."""
    parts = []
    spark = None
    for name, df in sources.items():
        if df is None:
            continue
        spark = df.sparkSession
        parts.append(df.limit(1).agg(F.count(F.lit(1)).alias("_n"))
                     .select(F.lit(name).alias("source"), (F.col("_n") > 0).alias("present")))
    missing = [n for n, df in sources.items() if df is None]
    if missing and spark is not None:
        parts.append(spark.createDataFrame([(n, False) for n in missing], "source string, present boolean"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def export_tables(tables: dict[str, DataFrame | None], root: str, stamp: str,
                  fmt: str = "csv") -> list[str]:
    """Write every present result table as ``<root>/<name>_<stamp>`` (CSV with header or JSON)."""
    written = []
    for name, df in tables.items():
        if df is None:
            continue
        w = df.write.mode("errorifexists")
        path = f"{root.rstrip('/')}/{name}_{stamp}"
        (w.option("header", "true").csv(path) if fmt == "csv" else w.json(path))
        written.append(path)
    return written


def source_profile(sources: dict[str, DataFrame | None]) -> DataFrame:
    """Per registered source its rows, column count and whether it has data.

    Absent sources are listed with 0 rows. The row counts come from one aggregate each.
    """
    parts = []
    spark = None
    for name, df in sources.items():
        if df is None:
            continue
        spark = df.sparkSession
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("source"), "rows", F.lit(len(df.columns)).cast("long").alias("columns"),
            (F.col("rows") > 0).alias("present")))
    for name in [n for n, df in sources.items() if df is None]:
        parts.append(spark.createDataFrame([(name, 0, 0, False)],
                                           "source string, rows long, columns long, present boolean"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
