"""Row filters used while cleaning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.text import present


def digits_only(text: Column) -> Column:
    return text.rlike("^[0-9]+$")


def valid_measures(df: DataFrame, *names: str, zero: bool = False) -> DataFrame:
    """Keep rows whose measures are all filled and positive (or not negative)."""
    tests = [(F.col(n) >= 0) if zero else (F.col(n) > 0) for n in names]
    return df.filter(reduce(lambda a, b: a & b, tests))


def drop_blank(df: DataFrame, name: str) -> DataFrame:
    return df.filter(present(F.col(name)).isNotNull())


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Remove rows in which every column is null or blank."""
    filled = [present(F.col(c).cast("string")) for c in df.columns]
    return df.filter(F.coalesce(*filled).isNotNull())
