"""Spark session helpers.

The library never relies on a particular session: every operator takes DataFrames and
returns DataFrames. These helpers only build a session for tests, the bench and local
runs, and resolve the shared checkpoint folder the cluster names in
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale. AQE re-plans joins and coalesces small shuffle
# partitions at run time; skew-join splitting handles a hot contract key in the
# semi/inner joins on ``contractid``.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "policy-analytics", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (the UI stays off)."""
    if shuffle_partitions is None:
        shuffle_partitions = 8 if cores == "*" else max(2, int(cores))
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", os.environ.get("PA_DRIVER_MEMORY", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a private one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is.
    Only when it is unset (local tests) a fresh scratch folder is taken.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pa-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def together(calls: list) -> list:
    """Results of independent calls that each run Spark jobs, submitted at once (one thread each)."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    if not calls:
        return []
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(calls)) as pool:
        return [f.result() for f in [pool.submit(inherit(c)) for c in calls]]
