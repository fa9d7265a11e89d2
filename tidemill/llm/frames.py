"""What the operators need of Spark beside DataFrames: imports in workers, files in the shared folder, schemas."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# Rows hold whole texts, so fewer of them make a batch than Spark's default; long ones are bounded by bytes.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def importable(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it, and get batches of bounded size."""
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(":")
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = ":".join([root, *filter(None, paths)])


def filesystem(uri: str):
    """The file system of a shared folder and the path in it, for use inside tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def fields(df: DataFrame, *extra: tuple[str, T.DataType], keep: list[str] | None = None) -> T.StructType:
    """The schema of some columns of ``df`` followed by further ones."""
    kept = [df.schema[c] for c in (df.columns if keep is None else keep)]
    return T.StructType([*kept, *[T.StructField(n, k) for n, k in extra]])
