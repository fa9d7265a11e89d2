"""Databases and tables of the catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

BUCKET_ROWS = 1 << 18


def recreate_database(spark: SparkSession, name: str, location: str) -> None:
    """Drop a database with all its tables and create it empty."""
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{location}'")


def save_external(df: DataFrame, table: str, path: str) -> None:
    """Write Parquet files to ``path`` and register them as a table."""
    df.write.mode("overwrite").option("path", path).saveAsTable(table)


def buckets_for(*tables: DataFrame, least: int = 8) -> int:
    """How many buckets keep a task's share of the largest table bounded; tables joined in buckets need one number."""
    return max(least, *[-(-df.count() // BUCKET_ROWS) for df in tables])


def save_bucketed(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, spread: bool = True) -> None:
    """Store rows in buckets of a hash of their keys, sorted in each, so that joins on the keys move none of them.

    One file per bucket; ``spread=False`` for rows that come from such a table mostly: they stay in the tasks
    that read them, and the others are written as further files of their buckets. For keys without hot values.
    """
    rows = df.repartition(buckets, *keys) if spread else df
    rows.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)


def register_location(spark: SparkSession, table: str, path: str) -> None:
    """Make files already written readable as a table."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")


def load_csv_table(spark: SparkSession, table: str, schema: str, path: str) -> None:
    """Bulk-load CSV files with a header into a typed table."""
    df = spark.read.option("header", True).schema(schema).csv(path)
    df.write.mode("overwrite").saveAsTable(table)


def append_rows(df: DataFrame, table: str) -> None:
    """Append to an existing table, matching columns by name; missing ones become null."""
    target = df.sparkSession.table(table)
    aligned = target.limit(0).unionByName(df, allowMissingColumns=True)
    aligned.select(*target.columns).write.mode("append").saveAsTable(table)


def rebuild_model(df: DataFrame, table: str) -> None:
    """Replace a model's table by its newly computed rows."""
    df.write.mode("overwrite").saveAsTable(table)
