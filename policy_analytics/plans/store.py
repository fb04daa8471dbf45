"""Registered snapshot and file round-trip queries.

Each builder runs the publish pipeline (clean -> write a new version into a fresh store
under the shared checkpoint folder) and returns a lazy read of what was written.
"""

from __future__ import annotations

import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import clean
from ..sources import fixtures as fx
from ..sources import io, layout, store
from ..session import shared_dir
from .cleaning import CLEAN_CTES
from .oracle import q
from .registry import register


def publish_clean(spark, d, rows_per_file=layout.ROWS_PER_FILE):
    """Clean the three raw tables and publish them as one new version; returns (root, result).

    The raw tables are read once, into a staging folder that table, audit and histogram read.
    """
    t0 = time.perf_counter()
    raw = {n: fx.RAW_VIEWS[n](spark, d) for n in store.TABLES}
    root = store.new_store_root(spark)
    data, results = clean.clean_all_results(raw, fx.AS_OF, staging=f"{root}/staging")
    res = store.publish(data, lambda counts: clean.full_logs(results, counts), root,
                        cleaning_seconds=round(time.perf_counter() - t0, 2),
                        histograms={n: r.staged for n, r in results.items()}, rows_per_file=rows_per_file)
    if not res["success"]:
        raise RuntimeError(f"publish failed: {res.get('error')}")
    return root, res


@register("snapshot_counts", q("""
SELECT 'contracts' AS table_name, (SELECT count(*) FROM cc_clean) AS rows
UNION ALL SELECT 'customers', (SELECT count(*) FROM cu_clean)
UNION ALL SELECT 'timeseries', (SELECT count(*) FROM ts_clean)""", CLEAN_CTES), headline=True)
def snapshot_counts(spark, d):
    """Publish a cleaned version, then rows per table of that version."""
    root, res = publish_clean(spark, d)
    inv = store.table_inventory(spark, root)
    return inv.where(F.col("version_id") == res["version_id"]).select("table_name", "rows")


@register("snapshot_roundtrip", q("SELECT * FROM ts_clean", CLEAN_CTES))
def snapshot_roundtrip(spark, d):
    """Publish, resolve the newest version, load its series table."""
    root, _ = publish_clean(spark, d)
    v = store.latest_version(spark, root)
    return store.load_version(spark, root, v)["timeseries"].select("contractid", "date", "surrender_value")


@register("snapshot_verify", q("""
SELECT CAST(count(*) AS BIGINT) AS tables, CAST(1 AS BIGINT) AS versions, CAST(sum(n) AS BIGINT) AS rows, min(n) > 0 AS ok
FROM (SELECT count(*) AS n FROM cc_clean UNION ALL SELECT count(*) FROM cu_clean UNION ALL SELECT count(*) FROM ts_clean) t""", CLEAN_CTES))
def snapshot_verify(spark, d):
    """The newest version is checked by content: rows and digests of every file against its index."""
    root, _ = publish_clean(spark, d)
    return store.verify_store(spark, root)


LOOKUP_KEYS = 20


@register("snapshot_lookup", q(f"""
SELECT * FROM ts_clean WHERE contractid IN (
  SELECT contractid FROM ts_clean GROUP BY contractid ORDER BY count(*) DESC, contractid LIMIT {LOOKUP_KEYS})""", CLEAN_CTES))
def snapshot_lookup(spark, d):
    """The series of the contracts with most rows, looked up through the file index of a snapshot."""
    root, res = publish_clean(spark, d, rows_per_file=50_000)
    rows = store.load_version(spark, root, res["version_id"])["timeseries"]
    top = (rows.groupBy("contractid").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.col("n").desc(), "contractid").limit(LOOKUP_KEYS).collect())
    return store.lookup(spark, root, res["version_id"], "timeseries", [r["contractid"] for r in top])


@register("json_records", q("SELECT * FROM raw_timeseries"))
def json_records(spark, d):
    """The raw series written as keyed JSON objects and read back as rows."""
    path = shared_dir(spark, f"json/{store.uuid.uuid4().hex}")
    raw = fx.raw_timeseries(spark, d).withColumn("row_id", F.monotonically_increasing_id())
    io.write_series_json(raw, path, keyed=True, key="row_id")
    return io.read_series_json(spark, path, keyed=True)


@register("json_array_records", q("SELECT * FROM raw_timeseries"))
def json_array_records(spark, d):
    """The raw series written as JSON records and read back with a schema."""
    path = shared_dir(spark, f"json/{store.uuid.uuid4().hex}")
    io.write_series_json(fx.raw_timeseries(spark, d), path)
    return io.read_series_json(spark, path)


CONTRACT_SCHEMA = T.StructType([T.StructField("contractid", T.StringType()),
                                T.StructField("customerid", T.StringType()),
                                T.StructField("mandantid", T.StringType())])


@register("csv_roundtrip", q("SELECT * FROM cc_clean", CLEAN_CTES))
def csv_roundtrip(spark, d):
    """Cleaned contracts written as CSV (header) and read back with an explicit schema."""
    root = shared_dir(spark, f"csv/{store.uuid.uuid4().hex}")
    data = clean.clean_table(fx.raw_contracts(spark, d), "contracts", fx.AS_OF).data
    io.write_csv({"contracts": data}, root)
    return io.read_table(spark, f"{root}/contracts", "csv", CONTRACT_SCHEMA)


LANDED_SCHEMA = T.StructType([T.StructField("contract_id", T.StringType()), T.StructField("datum", T.DateType()),
                              T.StructField("rueckkaufswert", T.DoubleType())])


def land_csv(spark, d):
    """The raw series as CSV lines, columns not in the order of the schema; some lines lack a field, some amounts are no numbers."""
    raw = fx.raw_timeseries(spark, d)
    text = F.concat_ws(",", "datum", "rueckkaufswert", F.coalesce("contract_id", F.lit("")))
    path = shared_dir(spark, f"csv/{store.uuid.uuid4().hex}")
    amount = F.when(F.col("rueckkaufswert").startswith("EUR "), F.substring("rueckkaufswert", 5, 30)).otherwise(F.col("rueckkaufswert"))
    lines = raw.withColumn("rueckkaufswert", amount).select(
        F.when(F.col("datum") == "1985-01-01", F.concat_ws(",", "datum", "rueckkaufswert")).otherwise(text)
        .alias("datum,rueckkaufswert,contract_id"))
    # the separator does not occur, so that lines and header are written as they are
    lines.write.option("header", "true").option("sep", "\x01").option("quote", "").csv(path)
    return path


LANDED = """
landed AS (SELECT contract_id, datum, regexp_replace(rueckkaufswert, '^EUR ', '') AS amount FROM raw_timeseries),
judged AS (SELECT contract_id, datum, amount, datum <> '1985-01-01' AND amount <> 'n/a' AS sound FROM landed)
"""


@register("csv_accepted", q("""
SELECT contract_id, CAST(datum AS DATE) AS datum, CAST(amount AS DOUBLE) AS rueckkaufswert FROM judged WHERE sound""", LANDED))
def csv_accepted(spark, d):
    """Sound lines of a landed CSV whose header has another column order than the schema."""
    return io.read_csv(spark, land_csv(spark, d), LANDED_SCHEMA, reject="line").where("line IS NULL").drop("line")


@register("csv_intake_log", q("""
SELECT 'timeseries' AS source, count(*) AS lines, count_if(sound) AS accepted, count_if(NOT sound) AS rejected FROM judged""", LANDED))
def csv_intake_log(spark, d):
    """Lines, accepted and rejected lines of the landed CSV."""
    return io.intake_log({"timeseries": (io.read_csv(spark, land_csv(spark, d), LANDED_SCHEMA, reject="line"), "line")})


def land_json(spark, d):
    """The raw series as JSON documents of all shapes: records, arrays, keyed objects, scalars, and cut lines."""
    raw = fx.raw_timeseries(spark, d).where("contract_id IS NOT NULL")
    one = F.to_json(F.struct("contract_id", "datum", "rueckkaufswert"))
    other = F.to_json(F.struct(F.col("contract_id").alias("Contract ID"), F.col("datum").alias(" DATE"), F.col("rueckkaufswert").alias("Surrender-Value")))
    line = (F.when(F.col("datum") == "1985-01-01", F.substring(one, 1, 30))
            .when(F.col("rueckkaufswert") == "n/a", F.lit('["n/a"]'))
            .when(F.col("rueckkaufswert") == "-1.00", F.lit("-1.00"))
            .when(F.col("rueckkaufswert") < "EUR 2", F.concat(F.lit("["), one, F.lit(","), other, F.lit("]")))
            .when(F.col("rueckkaufswert") < "EUR 3", F.concat(F.lit('{"a":'), other, F.lit("}")))
            .otherwise(other))
    path = shared_dir(spark, f"json/{store.uuid.uuid4().hex}")
    raw.select(line.alias("value")).write.text(path)
    return path


@register("json_shapes", q("""
SELECT NULL AS contractid, NULL AS date, 'n/a' AS surrender_value, count(*) AS n FROM r WHERE sound AND rueckkaufswert = 'n/a' HAVING count(*) > 0
UNION ALL SELECT NULL, NULL, '-1', count(*) FROM r WHERE sound AND rueckkaufswert = '-1.00' HAVING count(*) > 0
UNION ALL SELECT NULL, NULL, 'bad', count(*) FROM r WHERE NOT sound HAVING count(*) > 0
UNION ALL SELECT contract_id, datum, rueckkaufswert, CAST(sum(CASE WHEN rueckkaufswert < 'EUR 2' THEN 2 ELSE 1 END) AS BIGINT)
FROM r WHERE sound AND rueckkaufswert LIKE 'EUR %' GROUP BY ALL""", """
r AS (SELECT *, datum <> '1985-01-01' AS sound FROM raw_timeseries WHERE contract_id IS NOT NULL)"""))
def json_shapes(spark, d):
    """S3: records, arrays, keyed objects and scalars under several field names, with how often each row occurs; malformed lines counted."""
    rows = io.read_json_shapes(spark, land_json(spark, d), corrupt="line")
    return (rows.withColumn("surrender_value", F.when(F.col("line").isNotNull(), F.lit("bad")).otherwise(F.col("surrender_value")))
            .groupBy("contractid", "date", "surrender_value").agg(F.count(F.lit(1)).alias("n")))


@register("source_profile", q("""
SELECT 'contracts' AS source, count(*) AS rows, CAST(3 AS BIGINT) AS columns, count(*) > 0 AS present
FROM raw_contracts
UNION ALL SELECT 'customers', count(*), 2, count(*) > 0 FROM raw_customers
UNION ALL SELECT 'timeseries', count(*), 3, count(*) > 0 FROM raw_timeseries"""))
def source_profile(spark, d):
    """Rows, columns and presence of the three raw sources."""
    return io.source_profile({n: fx.RAW_VIEWS[n](spark, d) for n in store.TABLES})
