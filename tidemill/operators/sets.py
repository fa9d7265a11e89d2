"""Unions and removal of duplicates with a stated survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def keep_first(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """One row per key, the first in the given order.

    Spark keeps only the first row per key in each map task before the shuffle, so copies of
    a hot key do not travel.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    first = df.withColumn("_place", F.row_number().over(window)).filter("_place = 1")
    return first.drop("_place")


def first_seen(df: DataFrame, value: str, position: str) -> DataFrame:
    """Each value with the position it first appeared at."""
    return df.groupBy(value).agg(F.min(position).alias(position))
