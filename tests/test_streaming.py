"""Incremental publishing: each landed batch becomes one version, replays add nothing."""

from pyspark.sql import functions as F

from policy_analytics.session import shared_dir
from policy_analytics.sources import fixtures as fx
from policy_analytics.sources import store
from policy_analytics.streaming import ingest
from conftest import SMOKE


def test_landed_batches_become_versions(spark):
    base = shared_dir(spark, f"stream-test/{store.uuid.uuid4().hex}")
    landing, root, ckpt = f"{base}/landing", f"{base}/store", f"{base}/ckpt"
    raw = fx.raw_timeseries(spark, SMOKE)
    first = raw.where(F.col("datum") < "1995-01-01")
    second = raw.where((F.col("datum") >= "1995-01-01") | F.col("datum").isNull())
    first.write.json(f"{landing}/part1")
    q = ingest.start_series_ingest(spark, f"{landing}/*", root, ckpt, fx.AS_OF)
    q.awaitTermination()
    v1 = store.list_versions(spark, root).collect()
    assert len(v1) == 1
    assert v1[0].timeseries_rows == ingest.clean.clean_table(first, "timeseries", fx.AS_OF).data.count()
    q = ingest.start_series_ingest(spark, f"{landing}/*", root, ckpt, fx.AS_OF)   # nothing new
    q.awaitTermination()
    assert store.list_versions(spark, root).count() == 1
    second.write.json(f"{landing}/part2")
    q = ingest.start_series_ingest(spark, f"{landing}/*", root, ckpt, fx.AS_OF)
    q.awaitTermination()
    vs = store.list_versions(spark, root).collect()
    assert len(vs) == 2 and sum(v.timeseries_rows for v in vs) > 0
    # replaying a published batch id is a no-op
    assert ingest.publish_batch(first, 0, root, fx.AS_OF) is None
