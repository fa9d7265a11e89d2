"""Streams: file arrival, JSON topics, typed feeds, change application and correlation."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructField, StructType, VariantType

from tidemill.operators.changes import scd2_step, upsert_newer
from tidemill.operators.quality import keep_expected
from tidemill.schemas import FEEDS
from tidemill.sources.tables import BucketTable, completed

LATENESS = "2 minutes"


def decode(messages: DataFrame, schema: str) -> DataFrame:
    """Columns of the JSON text in ``value``; text that is no JSON gives a row of nulls."""
    text = messages.selectExpr("CAST(value AS STRING) AS value")
    return text.select(F.from_json("value", schema).alias("data")).select("data.*")


def read_topic(
    spark: SparkSession,
    source: str,
    options: Mapping[str, str],
    schema: str,
    event_time: str = "timestamp",
    lateness: str = LATENESS,
) -> DataFrame:
    """Decode a topic of JSON messages and watermark it.

    ``source="kafka"`` with ``subscribe`` and ``startingOffsets=earliest`` in production;
    ``source="text"`` with ``path`` reads the same messages from files.
    """
    reader = spark.readStream.format(source)
    for key, value in options.items():
        reader = reader.option(key, value)
    return decode(reader.load(), schema).withWatermark(event_time, lateness)


def once(messages: DataFrame, key: str = "id") -> DataFrame:
    """Each message once, though a topic delivers it again: repeats of a key within the watermark are dropped.

    The key is the sender's message id. Ids leave the state as the watermark passes them; what comes again
    after that is late, and late messages are dropped. So none arrives twice, and none within the lateness is lost.
    """
    return messages.dropDuplicatesWithinWatermark([key])


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }


def read_feeds(
    spark: SparkSession, source: str, options: Callable[[str], Mapping[str, str]],
    schemas: Mapping[str, str] = FEEDS,
) -> dict[str, DataFrame]:
    """One typed stream per feed; ``options`` gives the reader options of a feed."""
    return {
        name: read_topic(spark, source, options(name), schema).alias(name)
        for name, schema in schemas.items()
    }


def parse_location(location):
    """``(lat, lon)`` of a location kept as the text of a JSON array."""
    pair = F.from_json(location, "array<double>")
    return F.struct(F.get(pair, F.lit(0)).alias("lat"), F.get(pair, F.lit(1)).alias("lon"))


def write_feed(df: DataFrame, path: str, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Append a stream to Parquet; ``drain`` stops after the data available now."""
    writer = (
        df.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", path)
    )
    return (writer.trigger(availableNow=True) if drain else writer).start()


def write_feeds(feeds: Mapping[str, DataFrame], folder: str, drain: bool = False) -> dict[str, StreamingQuery]:
    """Independent sinks, each with its own checkpoint."""
    return {
        name: write_feed(df, f"{folder}/data/{name}", f"{folder}/checkpoints/{name}", drain)
        for name, df in feeds.items()
    }


def await_all(queries: Iterable[StreamingQuery]) -> None:
    """Wait for every query; the first failure is raised and the others are stopped."""
    queries = running = list(queries)
    try:
        while running:
            running = [query for query in running if not query.awaitTermination(1)]
    finally:
        for query in queries:
            if query.isActive:
                query.stop()


def tracked_schema(spark: SparkSession, path: str, location: str) -> StructType:
    """The schema kept at ``location``; the first run takes it from the files and keeps it."""
    try:
        kept = spark.read.text(location, wholetext=True).first()[0]
        schema = StructType.fromJson(json.loads(kept))
        arrived = spark.read.option("mergeSchema", True).parquet(path).schema
        added = [f.name for f in arrived if f.name.lower() not in {k.name.lower() for k in schema}]
        if added:
            raise ValueError(f"{path} has new columns {added} beside {schema.names}")
        return schema
    except AnalysisException:
        schema = spark.read.parquet(path).schema
        one = spark.createDataFrame([(schema.json(),)], "value STRING")
        one.coalesce(1).write.text(location)
        return schema


def ingest_files(
    spark: SparkSession, names: Iterable[str], source: Callable[[str], str], landing: str,
    schemas: Mapping[str, str] | None = None,
) -> None:
    """Copy newly arrived Parquet files of each data set to its landing folder, once.

    Without given schemas, that of the first run is kept beside the data and used from then on.
    Files that later bring a column the kept schema lacks stop the job before anything is
    copied, since the column would be lost.
    """
    streams = {}
    for name in names:
        schema = (
            schemas[name] if schemas else tracked_schema(spark, source(name), f"{landing}/schemas/{name}")
        )
        streams[name] = spark.readStream.schema(schema).parquet(source(name))
    await_all(write_feeds(streams, landing, drain=True).values())


class Landing:
    """Arriving Parquet files of one data set, landed without losing fields the tracked schema lacks.

    Unknown fields go to the variant column ``RESCUED``; ``widen`` promotes them, for rows that landed before as
    well. A micro-batch reads the footers of its own files only, and lands in a folder of its own, which a replay
    writes again. A file whose field has another type than the tracked one fails the job.
    """

    RESCUED = "_rescued_data"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def schema(self) -> StructType | None:
        """The tracked fields, from the latest version of the schema."""
        versions = completed(self.spark, f"{self.path}/schema", "version")
        if not versions:
            return None
        text = self.spark.read.text(f"{self.path}/schema/version={versions[-1]}", wholetext=True).first()[0]
        return StructType.fromJson(json.loads(text))

    def _track(self, schema: StructType) -> None:
        versions = completed(self.spark, f"{self.path}/schema", "version")
        version = versions[-1] + 1 if versions else 0
        one = self.spark.createDataFrame([(schema.json(),)], "value STRING")
        one.coalesce(1).write.mode("overwrite").text(f"{self.path}/schema/version={version}")

    def land(self, source: str, files: int = 1000) -> None:
        """Land the files that have arrived since the last run, at most ``files`` of them in a micro-batch."""
        if self.schema() is None:
            self._track(self.spark.read.parquet(source).schema)
        # The stream only says which files are new; a file without rows has nothing to land.
        names = self.spark.readStream.schema(self.schema()).option("maxFilesPerTrigger", files).parquet(source)
        names = names.select(F.col("_metadata.file_path").alias("file"))
        query = names.writeStream.foreachBatch(self._land).option("checkpointLocation", f"{self.path}/checkpoint")
        await_all([query.trigger(availableNow=True).start()])

    def _land(self, batch: DataFrame, number: int) -> None:
        files = [r.file for r in batch.distinct().collect()]  # at most the files of a micro-batch
        if not files:
            return
        schema = self.schema()
        rows = self.spark.read.option("mergeSchema", True).parquet(*files)
        own = {f.name.lower(): f for f in rows.schema}
        tracked = [F.col(own[f.name.lower()].name) if f.name.lower() in own else F.lit(None) for f in schema]
        changed = [f.name for f in schema if f.name.lower() in own and own[f.name.lower()].dataType != f.dataType]
        if changed:
            raise ValueError(f"{changed} arrived with another type than in {schema.simpleString()}")
        unknown = [f.name for key, f in own.items() if key not in {f.name.lower() for f in schema}]
        filled = F.greatest(*[F.col(f"`{c}`").isNotNull() for c in unknown], F.lit(False), F.lit(False))
        rescued = F.when(filled, F.to_variant_object(F.struct(*[f"`{c}`" for c in unknown]))) if unknown else F.lit(None).cast("variant")
        landed = rows.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(tracked, schema)], rescued.alias(self.RESCUED))
        landed.write.mode("overwrite").parquet(f"{self.path}/data/batch={number}")

    def widen(self, fields: str) -> None:
        """Track further fields, given as a schema; rows that landed with them have them from now on."""
        schema = self.schema()
        added = StructType.fromDDL(fields)
        self._track(StructType([*schema, *[f for f in added if f.name.lower() not in {k.name.lower() for k in schema}]]))

    def read(self) -> DataFrame:
        """All landed rows under the latest schema; ``RESCUED`` holds what arrived unknown."""
        schema = self.schema()
        stored = StructType([*schema, StructField(self.RESCUED, VariantType())])
        rows = self.spark.read.schema(stored).option("recursiveFileLookup", True).parquet(f"{self.path}/data")
        rescued = lambda f: F.try_variant_get(self.RESCUED, f"$['{f.name}']", f.dataType.simpleString())
        first = len(self._first())
        return rows.select(
            *[f.name for f in schema[:first]], *[F.coalesce(F.col(f.name), rescued(f)).alias(f.name) for f in schema[first:]], self.RESCUED
        )

    def _first(self) -> StructType:
        text = self.spark.read.text(f"{self.path}/schema/version=0", wholetext=True).first()[0]
        return StructType.fromJson(json.loads(text))


def apply_changes(
    stream: DataFrame, rules: Mapping[str, str], apply: Callable[[DataFrame, int], object], checkpoint: str,
) -> StreamingQuery:
    """Drop rows that break a rule and hand every micro-batch to ``apply``."""
    return (
        keep_expected(stream, rules).writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def upsert_into(table: BucketTable, *sequence: str) -> Callable[[DataFrame, int], object]:
    """A batch function that merges into the buckets of its keys; see ``upsert_newer``.

    A late batch merges to the same rows, and one replayed after a failure is not applied twice.
    """
    return lambda batch, number: table.merge(batch, number, lambda old, new: upsert_newer(old, new, table.keys, *sequence))


def history_into(table: BucketTable, sequence: str, tracked: Sequence[str]) -> Callable[[DataFrame, int], object]:
    """A batch function that keeps the whole history of every key; see ``scd2_step``.

    Only the buckets of the batch's keys are read and rewritten. ``scd2_versions`` shows the versions.
    """
    return lambda batch, number: table.merge(batch, number, lambda old, new: scd2_step(old, new, table.keys, sequence, tracked))


def minute_average(feed: DataFrame, measure: str, event_time: str = "timestamp", width: str = "1 minute") -> DataFrame:
    """Tumbling average per device; our addition on top of the declared watermark."""
    grouped = feed.groupBy(F.window(event_time, width), "deviceId")
    return grouped.agg(F.avg(measure).alias(f"avg_{measure}"), F.count("*").alias("readings")).select(
        "deviceId", F.col("window.start").alias("window_start"), f"avg_{measure}", "readings"
    )
