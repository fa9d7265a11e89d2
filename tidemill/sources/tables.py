"""Stored tables: one Parquet folder per version, or hash buckets of a key that change one by one.

A write counts from the moment Spark marks its folder complete, so readers see whole versions only
and a failed write is written again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.changes import keyed
from tidemill.operators.joins import new_rows
from tidemill.operators.sets import keep_first
from tidemill.session import stored

BUCKET = "_bucket"


def completed(spark: SparkSession, folder: str, label: str) -> list[int]:
    """The numbers of the complete ``label=<number>`` folders; the driver sees folder names, never files of data."""
    return sorted(int(name.split("=")[1]) for name in _parents(spark, f"{folder}/{label}=*/_SUCCESS"))


def _parents(spark: SparkSession, pattern: str) -> list[str]:
    """The names of the folders that hold what a pattern finds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(path)
    return [s.getPath().getParent().getName() for s in found or []]


class FolderTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def versions(self) -> list[int]:
        """The numbers of the complete versions."""
        return completed(self.spark, self.path, "version")

    def folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def read(self, version: int | None = None) -> DataFrame:
        known = self.versions()
        if not known or version is not None and version not in known:
            raise ValueError(f"{self.path} has versions {known}, not {version}")
        return self.spark.read.parquet(self.folder(known[-1] if version is None else version))

    def write(self, df: DataFrame) -> int:
        """Store the next version; ``df`` may read earlier ones."""
        known = self.versions()
        version = known[-1] + 1 if known else 0
        df.write.mode("overwrite").parquet(self.folder(version))
        return version

    def sizes(self) -> DataFrame:
        """Rows of each version."""
        counts = None
        for version in self.versions():
            one = self.read(version).agg(F.lit(version).alias("version"), F.count("*").alias("rows"))
            counts = one if counts is None else counts.unionByName(one)
        return counts


class BucketTable:
    """A table in hash buckets of ``keys``, of which a merge reads and rewrites only those its batch touches.

    A merge first stores the new rows of its buckets beside the table, then overwrites these
    buckets, then marks the batch as applied. A job that dies in between is carried on by the next
    merge from the stored rows, and a batch that was applied is not applied again. Batches are numbered by
    their ``writer``, and one writer works at a time. Readers may meet a merge half done; read between merges.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 256):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.data = f"{self.path}/buckets={buckets}"

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def read(self, touched: Sequence[int] | None = None) -> DataFrame | None:
        """The rows, or those of some buckets; None before the first merge."""
        if not _parents(self.spark, self.data):
            return None
        rows = self.spark.read.parquet(self.data)
        if touched is not None:
            rows = rows.filter(F.col(BUCKET).isin(list(touched)))
        return rows.drop(BUCKET)

    def merge(
        self, batch: DataFrame, number: int, apply: Callable[[DataFrame | None, DataFrame], DataFrame], writer: str = "main"
    ) -> bool:
        """Replace the rows of the batch's buckets by ``apply(rows, batch)``; False if the batch was applied before.

        ``apply`` must keep every row in the bucket of its key, and a bucket it empties stays as it was.
        """
        done = f"{self.path}/applied/writer={writer}"
        self._carry_on(done)
        if number in completed(self.spark, done, "batch"):
            return False
        batch = stored(batch, "batch")
        touched = sorted(r[0] for r in batch.select(self.bucket()).distinct().collect())  # at most ``buckets`` numbers
        if touched:
            changed = apply(self.read(touched), batch).withColumn(BUCKET, self.bucket())
            # One task per bucket, more for a large one.
            changed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self._staged(done, number))
        self._publish(done, number, bool(touched))
        return True

    def _staged(self, done: str, number: int) -> str:
        return f"{done.replace('/applied/', '/staged/')}/batch={number}"

    def _publish(self, done: str, number: int, filled: bool = True) -> None:
        if filled:
            rows = self.spark.read.parquet(self._staged(done, number)).hint("rebalance", BUCKET)
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.data)
        self.spark.range(1).write.mode("overwrite").parquet(f"{done}/batch={number}")

    def _carry_on(self, done: str) -> None:
        staged = completed(self.spark, done.replace("/applied/", "/staged/"), "batch")
        applied = set(completed(self.spark, done, "batch"))
        for number in staged:
            if number not in applied:
                self._publish(done, number)


class KeyFilter:
    """Which keys a table may hold: a bitmap by hashes of its keys, stored beside it in blocks of 32,768 bits.

    A key whose bits are not all set was never added. Two hashes per key keep wrong hits to the square of
    the share of bits set, so ``blocks`` should give some ten bits per key.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], blocks: int = 1 << 15, folders: int = 256):
        self.keys, self.blocks = list(keys), blocks
        self.table = BucketTable(spark, path, ["block"], folders)

    def _places(self, rows: DataFrame) -> DataFrame:
        """One row per hash of a row's key: its block and its bit there."""
        hashes = F.array(*[F.pmod(F.xxhash64(F.lit(i), *self.keys), F.lit(self.blocks * 32768)) for i in (1, 2)])
        placed = rows.withColumn("_hash", F.explode(F.array_distinct(hashes)))
        return placed.withColumns({"block": F.floor(F.col("_hash") / 32768), "_bit": F.col("_hash") % 32768}).drop("_hash")

    def add(self, rows: DataFrame, number: int, writer: str = "main") -> bool:
        """Set the bits of keys; adding them again changes nothing."""
        bits = self._places(rows.select(*self.keys)).groupBy("block").agg(F.bitmap_construct_agg("_bit").alias("bitmap"))

        def joined(old: DataFrame | None, new: DataFrame) -> DataFrame:
            both = new if old is None else old.unionByName(new)
            return both.groupBy("block").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))

        return self.table.merge(bits, number, joined, writer)

    def possible(self, rows: DataFrame) -> DataFrame:
        """The distinct keys of ``rows`` that may be held; the table itself is not read."""
        keys, known = rows.select(*self.keys).distinct(), self.table.read()
        if known is None:
            return keys.limit(0)
        held = F.conv(F.hex(F.substring("bitmap", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = F.expr("shiftright(_byte, CAST(_bit % 8 AS INT)) & 1") == 1
        hits = self._places(keys).join(known, "block", "left").withColumn("_byte", F.coalesce(held, F.lit(0)))
        return hits.groupBy(*self.keys).agg(F.min(is_set.cast("int")).alias("_all")).filter("_all = 1").drop("_all")


def insert_absent(table: BucketTable, known: KeyFilter, batch: DataFrame, number: int, writer: str = "main") -> list[int]:
    """Append the rows whose key the table lacks, one per key; a null key is an error. Gives the buckets that were read.

    Stored rows are read only in buckets of keys that the filter takes as possible. Bits are set before rows
    are appended, and rows that a job cut short did append are found again, so a replay adds nothing twice.
    """
    batch = stored(keep_first(keyed(batch, table.keys), table.keys, *[F.col(c) for c in batch.columns]), "batch")
    hits = stored(known.possible(batch).withColumn(BUCKET, table.bucket()), "hits")
    buckets = sorted(r[0] for r in hits.select(BUCKET).distinct().collect())  # at most the table's number of buckets
    held = table.read(buckets) if buckets else None
    new = batch if held is None else new_rows(batch, held.select(*table.keys).join(hits.drop(BUCKET), table.keys, "left_semi"), table.keys)
    known.add(batch, number, writer)
    new.withColumn(BUCKET, table.bucket()).hint("rebalance", BUCKET).write.mode("append").partitionBy(BUCKET).parquet(table.data)
    return buckets
