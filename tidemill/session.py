"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a running session accepts. Partition counts are left to the cluster.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every job here relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "tidemill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def stateful(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of the same application whose streams keep their state in RocksDB.

    State with timers needs it, and it holds far more than memory. ``partitions`` spreads the state, by default
    as the given session shuffles; a stream keeps the number of its first run. The given session stays as it is.
    """
    own = spark.newSession()
    for key in ("spark.sql.shuffle.partitions", *RUNTIME_SETTINGS):
        own.conf.set(key, spark.conf.get(key))
    if partitions:
        own.conf.set("spark.sql.shuffle.partitions", partitions)
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    return own


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder the cluster shares (``spark.checkpoint.dir``).

    Without that setting the session's warehouse folder is used, which a deployment points at
    shared storage too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tidemill/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again: later jobs neither repeat nor lose it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Jobs within leave no shuffle files behind once they end: what later jobs need has to be ``stored``."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)
