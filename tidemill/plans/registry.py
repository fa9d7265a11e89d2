"""Registry of the queries bound to the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemill.session import scratch_path, tune


class Tables:
    """The tables below one folder, read lazily as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = tune(spark)
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def arrivals(self, name: str) -> str:
        """The same files as a pattern, which a file stream accepts for a file or a folder."""
        return f"{self.folder}/{name}.parquet*"

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.build(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same question asked in plain SQL."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return register
