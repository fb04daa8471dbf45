"""Versioned snapshot store on plain Parquet.

Layout under ``root`` (a folder in the shared storage the cluster names, never a
machine-local path)::

    tables/<table>/version_id=<v>/part-*.parquet   data, one partition per version
    file_index/<table>/version_id=<v>/             key range, rows and digest of every data file
    cleaning_logs/version_id=<v>/part-*.parquet    audit rows as JSON text
    data_versions/part-*.parquet                   one metadata row per version

Publishing writes every data table into a fresh ``version_id=`` folder (``errorifexists``:
a repeated id fails instead of overwriting), then the logs, and appends the metadata row
last. The metadata row is the commit point: readers only trust listed versions, so a
failed run leaves no visible version. Every file of a table holds one range of its key
(S20, :mod:`.layout`), so a lookup opens only the files whose range holds the key.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import one_row
from ..session import shared_dir, together
from . import layout

TABLES = ("contracts", "customers", "timeseries")
# Clustering keys per table (the reference indexes the same columns). A file
# holds one range of the first key, a hot key's rows are split by the second.
CLUSTER_KEYS = {"contracts": ("contractid",), "customers": ("customerid",),
                "timeseries": ("contractid", "date")}
# Keys that one lookup may name; join the loaded table for more.
MAX_LOOKUP_KEYS = 10_000

VERSION_SCHEMA = T.StructType([
    T.StructField("version_id", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("contracts_table_name", T.StringType()),
    T.StructField("customers_table_name", T.StringType()),
    T.StructField("timeseries_table_name", T.StringType()),
    T.StructField("contracts_rows", T.LongType()),
    T.StructField("customers_rows", T.LongType()),
    T.StructField("timeseries_rows", T.LongType()),
    T.StructField("total_rows", T.LongType()),
    T.StructField("cleaning_duration_seconds", T.DoubleType()),
    T.StructField("store_duration_seconds", T.DoubleType()),
    T.StructField("created_by", T.StringType()),
    T.StructField("notes", T.StringType()),
])


def new_store_root(spark: SparkSession, name: str = "snapshots") -> str:
    """A fresh store folder inside the shared checkpoint folder."""
    return shared_dir(spark, f"{name}/{uuid.uuid4().hex}")


def create_version_id(now: dt.datetime | None = None) -> str:
    """``v%Y%m%d_%H%M%S`` (inject ``now`` for deterministic ids)."""
    return (now or dt.datetime.now(dt.timezone.utc)).strftime("v%Y%m%d_%H%M%S")


def _table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/tables/{table}"


def _write_table(df: DataFrame, table: str, root: str, version_id: str, mode: str,
                 histogram: DataFrame | None, rows_per_file: int) -> None:
    """Write one table by key range, then its file index, read off the written files."""
    keys = CLUSTER_KEYS.get(table, ())
    path = f"{_table_path(root, table)}/version_id={version_id}"
    (layout.by_range(df, keys, histogram, rows_per_file).write.mode(mode)
     .options(**layout.bloom_options(keys, df.columns, rows_per_file)).parquet(path))
    spark = df.sparkSession
    (layout.file_index(spark.read.schema(df.schema).parquet(path), keys).coalesce(1)
     .write.mode(mode).parquet(_index_path(root, table, version_id)))


def _index_path(root: str, table: str, version_id: str) -> str:
    return f"{root.rstrip('/')}/file_index/{table}/version_id={version_id}"


def _rows_written(spark: SparkSession, root: str, tables: list[str], version_id: str) -> dict[str, int]:
    """Rows per table of a version, from the file indexes."""
    index = spark.read.schema(layout.INDEX_SCHEMA).parquet(*[_index_path(root, t, version_id) for t in tables])
    table = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3)
    return {r["t"]: r["n"] for r in index.groupBy(table.alias("t")).agg(F.sum("rows").alias("n")).collect()}


def publish(tables: dict[str, DataFrame | None], logs, root: str,
            notes: str = "Data cleaning pipeline run", version_id: str | None = None,
            cleaning_seconds: float | None = None, now: dt.datetime | None = None,
            data_mode: str = "errorifexists", histograms: dict[str, DataFrame] | None = None,
            rows_per_file: int = layout.ROWS_PER_FILE) -> dict:
    """Write a new version; returns id, per-table rows, durations and success.

    ``logs`` is a DataFrame or a function of the written row counts returning one (so the
    audit can use the counts from the written files instead of recomputing the tables).
    ``data_mode="overwrite"`` is only for re-publishing a version id that is known not to
    be listed (left over by a failed attempt, invisible to readers). ``histograms`` gives, per
    table, a written table with its keys (see :func:`.layout.by_range`); without one the table
    itself is computed for the histogram too.
    """
    start = time.perf_counter()
    spark = next(df for df in tables.values() if df is not None).sparkSession
    version_id = version_id or create_version_id(now)
    counts: dict[str, int | None] = {}
    names: dict[str, str | None] = {}
    try:
        there = [t for t in TABLES if tables.get(t) is not None]
        together([lambda t=t: _write_table(tables[t], t, root, version_id, data_mode, (histograms or {}).get(t), rows_per_file)
                  for t in there])
        counts = dict.fromkeys(TABLES) | dict.fromkeys(there, 0) | _rows_written(spark, root, there, version_id)
        names = {t: f"{t}_{version_id}" if t in there else None for t in TABLES}
        if callable(logs):
            logs = logs(counts)
        if logs is not None:
            log_json = logs if "log_json" in logs.columns else logs.select(
                F.col("table_type"), F.to_json(F.struct(*[F.col(c) for c in logs.columns])).alias("log_json"))
            log_json.coalesce(1).write.mode(data_mode).parquet(f"{root.rstrip('/')}/cleaning_logs/version_id={version_id}")
        store_seconds = round(time.perf_counter() - start, 2)
        present = [v for v in counts.values() if v is not None]
        meta = spark.createDataFrame([(
            version_id, (now or dt.datetime.now(dt.timezone.utc)).replace(tzinfo=None),
            names["contracts"], names["customers"], names["timeseries"],
            counts["contracts"], counts["customers"], counts["timeseries"], int(sum(present)),
            cleaning_seconds, store_seconds, "pyspark", notes)], VERSION_SCHEMA)
        meta.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/data_versions")   # commit point
        return {"version_id": version_id, "row_counts": counts, "total_rows": int(sum(present)),
                "store_duration_seconds": store_seconds, "success": True}
    except Exception as e:  # noqa: BLE001 - reported as the reference does, nothing committed
        return {"version_id": version_id, "row_counts": counts, "error": str(e), "success": False}


def lookup(spark: SparkSession, root: str, version_id: str, table: str, keys: list[str],
           days: tuple[dt.date, dt.date] | None = None) -> DataFrame | None:
    """The rows of some keys (and, for a dated table, of a range of days); unknown version -> None.

    Only files whose key and day range holds one of ``keys`` are opened; in them, row groups are
    passed over by their statistics and Bloom filters. At most :data:`MAX_LOOKUP_KEYS` keys.
    """
    if len(keys) > MAX_LOOKUP_KEYS:
        raise ValueError(f"{len(keys)} keys in one lookup: join load_version() for more than {MAX_LOOKUP_KEYS}")
    whole = (load_version(spark, root, version_id) or {}).get(table)
    if whole is None:
        return None
    key, *more = CLUSTER_KEYS[table]
    wanted = F.col(key).isin(list(keys))
    named = F.from_json(F.lit(json.dumps(sorted(set(keys)))), "array<string>")
    held = F.exists(named, lambda k: (k >= F.col("low_key")) & (k <= F.col("high_key")))
    if days is not None and more:
        wanted = wanted & F.col(more[0]).between(*days)
        held = held & (F.col("high_day") >= F.lit(days[0])) & (F.col("low_day") <= F.lit(days[1]))
    index = spark.read.schema(layout.INDEX_SCHEMA).parquet(_index_path(root, table, version_id))
    files = [r["file"] for r in index.where(held).select("file").collect()]     # at most layout.MAX_FILES
    base = f"{_table_path(root, table)}/version_id={version_id}"
    if not files:
        return whole.where(F.lit(False))
    return spark.read.schema(whole.schema).parquet(*[f"{base}/{f}" for f in files]).where(wanted)


def list_versions(spark: SparkSession, root: str) -> DataFrame:
    """Versions newest first (ties by id)."""
    v = spark.read.schema(VERSION_SCHEMA).parquet(f"{root.rstrip('/')}/data_versions")
    return (v.select("version_id", "created_at", "contracts_rows", "customers_rows", "timeseries_rows",
                     "total_rows", "cleaning_duration_seconds", "store_duration_seconds", "notes")
            .orderBy(F.col("created_at").desc(), F.col("version_id").desc()))


def latest_version(spark: SparkSession, root: str) -> str | None:
    """Id of the newest version (one small aggregate over the metadata table)."""
    row = (spark.read.schema(VERSION_SCHEMA).parquet(f"{root.rstrip('/')}/data_versions")
           .agg(F.max_by("version_id", F.struct("created_at", "version_id")).alias("v")).first())
    return row["v"] if row else None


def load_version(spark: SparkSession, root: str, version_id: str) -> dict[str, DataFrame] | None:
    """The tables of a listed version, each with that version's own columns; unknown id -> None."""
    meta = (spark.read.schema(VERSION_SCHEMA).parquet(f"{root.rstrip('/')}/data_versions")
            .where(F.col("version_id") == version_id).limit(1).collect())
    if not meta:
        return None
    m = meta[0]
    out = {}
    for t in TABLES:
        if m[f"{t}_table_name"] is None:
            continue
        out[t] = spark.read.parquet(f"{_table_path(root, t)}/version_id={version_id}")
    return out


def table_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Rows per table and listed version (footer counts). Folders of versions that were
    never committed are not counted; a listed table that cannot be read is an error."""
    empty = spark.createDataFrame([], "table_name string, version_id string, rows long")
    try:
        versions = spark.read.schema(VERSION_SCHEMA).parquet(f"{root.rstrip('/')}/data_versions")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":        # no version committed yet
            return empty
        raise
    listed = versions.select("version_id", *[f"{t}_table_name" for t in TABLES]).collect()
    parts = [empty]
    for t in TABLES:
        ids = sorted(v["version_id"] for v in listed if v[f"{t}_table_name"] is not None)
        if ids:
            paths = [f"{_table_path(root, t)}/version_id={v}" for v in ids]
            df = spark.read.option("basePath", _table_path(root, t)).schema("version_id string").parquet(*paths)
            parts.append(df.groupBy("version_id").agg(F.count(F.lit(1)).alias("rows"))
                         .select(F.lit(t).alias("table_name"), "version_id", "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def sample_rows(spark: SparkSession, root: str, pattern: str, version_id: str, n: int = 5) -> dict[str, DataFrame]:
    """First ``n`` rows of each table whose name matches ``pattern`` (regex)."""
    import re
    rx = re.compile(pattern)
    tables = load_version(spark, root, version_id) or {}
    return {t: df.limit(n) for t, df in tables.items() if rx.search(t)}


def load_log(spark: SparkSession, root: str, version_id: str) -> DataFrame | None:
    """The audit rows of a listed version as ``(table_type, log_json)``; unknown id -> None."""
    if not is_listed(spark, root, version_id):
        return None
    return (spark.read.schema("table_type string, log_json string")
            .parquet(f"{root.rstrip('/')}/cleaning_logs/version_id={version_id}"))


def verify_version(spark: SparkSession, root: str, version_id: str) -> DataFrame | None:
    """Per table of a listed version the rows found and whether its content is as written.

    Every file's rows and digest are computed anew and held against the file index: a file that
    is missing, altered, added or unreadable makes its table ``ok = false``.
    """
    meta = (spark.read.schema(VERSION_SCHEMA).parquet(f"{root.rstrip('/')}/data_versions")
            .where(F.col("version_id") == version_id).limit(1).collect())
    if not meta:
        return None
    rows = []
    for t in TABLES:
        if meta[0][f"{t}_table_name"] is None:
            continue
        try:
            # per file one small row; the comparison itself runs in Spark
            found = layout.file_index(spark.read.parquet(f"{_table_path(root, t)}/version_id={version_id}"),
                                      CLUSTER_KEYS[t]).select("file", F.col("rows").alias("n"), F.col("digest").alias("d"))
            index = spark.read.schema(layout.INDEX_SCHEMA).parquet(_index_path(root, t, version_id)).select("file", "rows", "digest")
            n, same = index.join(found, "file", "full").agg(
                F.coalesce(F.sum("n"), F.lit(0)).cast("long"),
                F.coalesce(F.every(F.col("rows").eqNullSafe(F.col("n")) & F.col("digest").eqNullSafe(F.col("d"))), F.lit(True))).first()
        except (PySparkException, Py4JJavaError) as e:
            n, same = None, False
            note = str(e).splitlines()[0]
        else:
            note = None if same else "content differs from the file index"
        rows.append((t, n, meta[0][f"{t}_rows"], bool(same) and n == meta[0][f"{t}_rows"], note))
    return spark.createDataFrame(rows, "table_name string, rows long, listed_rows long, ok boolean, note string")


def verify_store(spark: SparkSession, root: str) -> DataFrame:
    """Tables of the newest version, versions listed, rows found, and whether all is as published.

    ``ok``: at least one version, and every table of the newest one has rows and the content that was written.
    """
    versions = spark.read.schema(VERSION_SCHEMA).parquet(f"{root.rstrip('/')}/data_versions")
    newest = latest_version(spark, root)
    checked = verify_version(spark, root, newest) if newest else None
    if checked is None:
        return spark.createDataFrame([(0, 0, 0, False)], "tables long, versions long, rows long, ok boolean")
    return one_row(versions.agg(F.count(F.lit(1)).alias("versions")),
                   checked.agg(F.count(F.lit(1)).alias("tables"), F.sum("rows").cast("long").alias("rows"),
                               F.every(F.col("ok") & (F.col("rows") > 0)).alias("ok"))
                   ).select("tables", "versions", "rows", "ok")


def is_listed(spark: SparkSession, root: str, version_id: str) -> bool:
    """Whether ``version_id`` has a metadata row (i.e. is committed)."""
    try:
        v = spark.read.schema(VERSION_SCHEMA).parquet(f"{root.rstrip('/')}/data_versions")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":        # no version written yet
            return False
        raise                                           # unknown is not the same as unlisted
    return v.where(F.col("version_id") == version_id).limit(1).count() > 0
