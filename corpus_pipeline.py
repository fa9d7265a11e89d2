"""Training-text pipeline: stages over ``documents``, each stored before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm.stages import STAGES
from tidemill.session import stored

ORACLE_SQL = None  # fingerprints, suffix buckets and token ids have no SQL form; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, over the ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
