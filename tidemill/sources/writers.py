"""File sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import stored


def append_parquet(df: DataFrame, path: str) -> None:
    """Append; running it twice stores the rows twice."""
    df.write.mode("append").parquet(path)


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header in every part; an empty result still writes one header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_quoted_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, every field quoted and quotes in it doubled, so line breaks and blanks survive."""
    writer = df.write.option("header", True).option("quoteAll", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_split(df: DataFrame, error: Column, good_path: str, bad_path: str, id_column: str) -> None:
    """Good records to one folder, ``{id, error}`` of the others to another.

    The input is evaluated once, into a stored table; both outputs are read from that.
    """
    marked = stored(df.withColumn("error", error), "split")
    write_json_lines(marked.filter(F.col("error").isNull()).drop("error"), good_path)
    bad = marked.filter(F.col("error").isNotNull())
    write_json_lines(bad.select(F.col(id_column).cast("string").alias("id"), "error"), bad_path)
