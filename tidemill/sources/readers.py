"""Readers for CSV, Parquet, JSON, XML and text inputs. Production reads pass a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.filters import digits_only
from tidemill.operators.sets import first_seen
from tidemill.schemas import EPISODES


def read_csv(spark: SparkSession, path: str, schema: str | None = None, multiline: bool = False) -> DataFrame:
    """CSV with a header; types are inferred only where no schema is given.

    ``multiline`` reads quoted fields with line breaks and doubled quotes, one task per file.
    """
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    if multiline:
        reader = reader.option("multiLine", True).option("escape", '"')
    return reader.csv(path)


def read_parquet(spark: SparkSession, path: str, schema: str | None = None, recursive: bool = False) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", recursive)
    if schema:
        reader = reader.schema(schema)
    return reader.parquet(path)


def without_rescued(df: DataFrame, column: str = "_rescued_data") -> DataFrame:
    """Drop the column in which the landing job keeps fields that fit no schema."""
    return df.drop(column)


def read_delta_tree(spark: SparkSession, root: str, table: str, schema: str) -> DataFrame:
    """One table of a ``<date>/<hour>/<table>.csv`` tree, with its batch date and hour."""
    path = F.col("_metadata.file_path")
    place = r"/(?:date=)?([^/=]+)/(?:hour=)?([^/=]+)/(?:table=)?([^/.=]+)\.csv(?:/[^/]*)?$"
    return (
        spark.read.option("header", True).schema(schema).csv(f"{root.rstrip('/')}/*/*/{{table=,}}{table}.csv")
        .withColumns({
            "batch_date": F.regexp_extract(path, place, 1),
            "batch_hour": F.regexp_extract(path, place, 2),
            "table_name": F.regexp_extract(path, place, 3),
        })
    )


def line_position():
    """Sorts lines by file and place in the file, also when a file is read in several splits."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )


def read_id_list(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """Ids from the first CSV column, digits only, in first-seen order (``position``)."""
    rows = spark.read.option("encoding", encoding).schema("id STRING").csv(path, enforceSchema=True)
    ids = rows.select(F.trim("id").alias("id"), line_position().alias("position"))
    ids = first_seen(ids.filter(digits_only(F.col("id"))), "id", "position")
    if ids.isEmpty():
        raise ValueError(f"no ids found in {path}")
    return ids


def read_records(spark: SparkSession, schema: str, lines: str | None = None, arrays: str | None = None) -> DataFrame:
    """JSON records from files of lines and files holding one array each.

    Blank and broken lines are skipped; a broken array file yields nothing.
    """
    frames = []
    if lines:
        frames.append(spark.read.schema(schema).option("mode", "DROPMALFORMED").json(lines))
    if arrays:
        frames.append(
            spark.read.schema(schema).option("mode", "DROPMALFORMED").option("multiLine", True).json(arrays)
        )
    if not frames:
        raise ValueError("give a path of line files, of array files, or both")
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def read_feed_items(spark: SparkSession, path: str, schema: str = EPISODES) -> DataFrame:
    """The ``item`` elements of RSS documents."""
    return spark.read.format("xml").option("rowTag", "item").schema(schema).load(path)


def read_failed_ids(spark: SparkSession, pattern: str) -> DataFrame:
    """Ids of many error files, repeats kept; lines that are no JSON are skipped."""
    lines = spark.read.schema("id STRING").option("mode", "DROPMALFORMED").json(pattern)
    return lines.filter(F.col("id").isNotNull())
