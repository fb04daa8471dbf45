"""The corpus pipeline: toxicity, exact and near duplicates, source mix, packing.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and returns a
DataFrame, which is written as Parquet and read again as the next stage's ``docs``; all but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from policy_analytics.llm.common import fresh_path, table
from policy_analytics.llm.exact_dedup import keep_first_copies
from policy_analytics.llm.mixing import sample_mix
from policy_analytics.llm.near_dedup import keep_one_of_each_class
from policy_analytics.llm.packing import pack_documents
from policy_analytics.llm.toxicity import drop_toxic

STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", keep_first_copies),
    ("near_dedup", keep_one_of_each_class),
    ("mixing", sample_mix),
    ("packing", pack_documents),
]

# The stages learn, propagate and pack iteratively, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the packed pieces."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
