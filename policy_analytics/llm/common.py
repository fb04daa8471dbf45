"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir

# A word is a maximal run of characters other than these six ASCII spaces.
WORD = r"[^\x20\x09-\x0D]+"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return shared_dir(spark, f"llm/{name}-{uuid.uuid4().hex}")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage (a lost executor recomputes nothing upstream) and gives later joins a
    plain scan on this side, so that adaptive execution can split a hot key. The job's shuffle
    files go as soon as the table is written, not when the driver next collects its garbage.
    """
    path = fresh_path(df.sparkSession, name)
    with settings(df.sparkSession, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_saved(df: DataFrame) -> None:
    """Delete the files of a table that :func:`saved` wrote and nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm/" not in folder:
            raise ValueError(f"{folder} was not written by saved()")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def settings(spark: SparkSession, wanted: dict) -> Iterator[None]:
    """SQL settings that hold within the block."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, str(value))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: int) -> Iterator[None]:
    """Within the block, jobs hand at most ``rows`` rows or about ``size`` bytes at once to Python workers.

    For rows that carry long lists: what a worker, and the buffers of its executor, hold is
    bounded by a few batches, however long the lists are. Results do not depend on it.
    """
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}):
        yield


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A DataFrame of a bounded number of driver-side rows (JVM-side local relation)."""
    kind = T._parse_datatype_string(schema)
    body = [dict(zip(kind.names, r, strict=True)) for r in rows]
    import json
    text = json.dumps(body)
    element = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in kind.fields)
    return spark.range(1).select(
        F.inline(F.from_json(F.lit(text), f"array<struct<{element}>>")))


def seeded(column, seed: int):
    """64-bit hash of a column under a seed (null hashes like the seed alone)."""
    return F.xxhash64(column, F.lit(seed))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Bits of the bitmap that :func:`sift` broadcasts: at most 1 MB.
SIFT_BITS = 1 << 23


def sift(rows: DataFrame, column: str, marks: DataFrame, mark: str) -> DataFrame:
    """Rows whose long ``column`` may be among ``marks``: all that are, and a few more.

    A bitmap of fixed size is broadcast, so that rows without a partner are passed over in
    the scan, before the join that decides. Columns of ``rows`` must not start with "__sift".
    """
    return _marked(rows, column, marks, mark, "inner").where("__sift_hit").select(*rows.columns)


def sift_out(rows: DataFrame, column: str, marks: DataFrame, mark: str) -> DataFrame:
    """The rows that :func:`sift` leaves out: none of them is among ``marks``."""
    return _marked(rows, column, marks, mark, "left").where("not coalesce(__sift_hit, false)").select(*rows.columns)


def _marked(rows: DataFrame, column: str, marks: DataFrame, mark: str, how: str) -> DataFrame:
    place = "pmod(xxhash64({}), " + str(SIFT_BITS) + ")"
    bits = F.broadcast(marks.groupBy(F.expr(f"bitmap_bucket_number({place.format(mark)})").alias("__sift_bucket"))
                       .agg(F.expr(f"bitmap_construct_agg(bitmap_bit_position({place.format(mark)}))").alias("__sift_bits")))
    byte = F.conv(F.hex(F.expr("substring(__sift_bits, cast(__sift_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return (rows.withColumn("__sift_bucket", F.expr(f"bitmap_bucket_number({place.format(column)})"))
            .withColumn("__sift_bit", F.expr(f"bitmap_bit_position({place.format(column)})"))
            .join(bits, "__sift_bucket", how)
            .withColumn("__sift_hit", F.bit_get(byte, F.pmod("__sift_bit", F.lit(8)).cast("int")) == 1))
