"""Structured Streaming jobs, drained over the given tables and compared with batch answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import changes
from tidemill.operators.joins import correlate, correlate_all, correlate_within
from tidemill.plans.ingest import EVENTS, MICROSECONDS, READING, READINGS_SQL, readings
from tidemill.plans.ranking import SPEED_SQL
from tidemill.plans.registry import query
from tidemill.session import stateful
from tidemill.sources.tables import BucketTable
from tidemill.streaming import devices, feeds

BUCKETS = 8  # of tables that hold a row or a few per user
STATES = 4  # partitions of state at least
TOPICS = ["click", "error", "purchase", "signup", "view"]


def keeping_state(t):
    """A session whose streams spread their state over all cores of the cluster."""
    return stateful(t.spark, max(STATES, t.spark.sparkContext.defaultParallelism))


def event_stream(t):
    """The events as they would arrive from files, watermarked on ``timestamp``."""
    return readings(t.spark.readStream.schema(EVENTS).parquet(t.arrivals("events")))


def drain(t, stream, label: str):
    out = t.scratch(label)
    feeds.await_all([feeds.write_feed(stream, f"{out}/data", f"{out}/checkpoint", drain=True)])
    return t.spark.read.schema(stream.schema).parquet(f"{out}/data")


def without_zone(df, *names: str):
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


@query("stm_01_typed_feeds", """
    SELECT event_type AS feed, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1""")
def typed_feeds(t):
    topics, out = t.scratch("topics"), t.scratch("feeds")
    messages = readings(t.events)
    messages.select(
        F.to_json(F.struct(*messages.columns), MICROSECONDS).alias("value"), F.col("topic").alias("feed")
    ).write.partitionBy("feed").text(topics)
    streams = feeds.read_feeds(
        t.spark, "text", lambda name: {"path": f"{topics}/feed={name}"}, dict.fromkeys(TOPICS, READING)
    )
    feeds.await_all(feeds.write_feeds(streams, out, drain=True).values())
    counts = None
    for name in TOPICS:
        one = t.spark.read.schema(READING).parquet(f"{out}/data/{name}").agg(
            F.lit(name).alias("feed"), F.count("*").alias("n"), F.round(F.sum("speed"), 2).alias("total")
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query("stm_02_watermark_keeps_rows", READINGS_SQL)
def watermark_keeps_rows(t):
    stream = event_stream(t).withWatermark("timestamp", feeds.LATENESS)
    return without_zone(drain(t, stream, "watermark"), "timestamp")


@query("stm_03_independent_sinks", """
    SELECT event_type AS topic, user_id, count(*) AS n FROM events GROUP BY 1, 2""")
def independent_sinks(t):
    topics, out = t.scratch("topics"), t.scratch("sinks")
    rows = readings(t.events)
    rows.withColumn("feed", F.col("topic")).write.partitionBy("feed").parquet(topics)
    parts = {name: t.spark.readStream.schema(rows.schema).parquet(f"{topics}/feed={name}") for name in TOPICS}
    feeds.await_all(feeds.write_feeds(parts, out, drain=True).values())
    stored = t.spark.read.schema(READING).parquet(*[f"{out}/data/{name}" for name in TOPICS])
    return stored.groupBy("topic", F.col("deviceId").cast("bigint").alias("user_id")).agg(F.count("*").alias("n"))


@query("stm_04_drain_and_restart", "SELECT event_id, user_id, value FROM events")
def drain_and_restart(t):
    """Half of the files, a run, the other half, a second run with the same checkpoint."""
    arriving, out = t.scratch("arriving"), t.scratch("drained")
    events = t.events.select("event_id", "user_id", "value", "ts")
    for batch in ("ts < TIMESTAMP_NTZ '2024-01-16'", "ts >= TIMESTAMP_NTZ '2024-01-16'"):
        events.filter(batch).drop("ts").write.mode("append").parquet(arriving)
        stream = t.spark.readStream.schema("event_id BIGINT, user_id BIGINT, value DOUBLE").parquet(arriving)
        feeds.await_all([feeds.write_feed(stream, f"{out}/data", f"{out}/checkpoint", drain=True)])
    return t.spark.read.parquet(f"{out}/data")


@query("stm_05_streamed_changes", """
    SELECT user_id, event_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place
        FROM events WHERE value > 1) WHERE place = 1""")
def streamed_changes(t):
    """Rules drop rows from the stream; each micro-batch merges into the buckets of its keys.

    The later half of the events arrives first, so the second batch is late.
    """
    table = BucketTable(t.spark, t.scratch("changes"), ["user_id"], BUCKETS)
    log = t.events.select("user_id", "event_id", "event_type", "ts", "value")
    apply_halves(t, log, {"large": "value > 1"}, feeds.upsert_into(table, "ts", "event_id"))
    return table.read().select("user_id", "event_id", "event_type")


def apply_halves(t, log, rules, apply):
    """The later half of a log of events arrives first, the earlier one after a restart."""
    arriving, checkpoint = t.scratch("arriving"), t.scratch("checkpoint")
    for half in ("ts >= TIMESTAMP_NTZ '2024-01-16'", "ts < TIMESTAMP_NTZ '2024-01-16'"):
        log.filter(half).write.mode("append").parquet(arriving)
        stream = t.spark.readStream.schema(log.schema).parquet(arriving)
        feeds.await_all([feeds.apply_changes(stream, rules, apply, checkpoint)])


@query("stm_05_streamed_history", """
    WITH v AS (SELECT user_id, event_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS prior
               FROM events WHERE value > 1),
    c AS (SELECT user_id, event_type, event_id AS valid_from FROM v WHERE prior IS DISTINCT FROM event_type)
    SELECT *, lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_current
    FROM c WINDOW w AS (PARTITION BY user_id ORDER BY valid_from)""")
def streamed_history(t):
    """Every version of every user's last event, kept by micro-batches of which the second one is late."""
    table = BucketTable(t.spark, t.scratch("history"), ["user_id"], BUCKETS)
    log = t.events.select("user_id", "event_id", "event_type", "ts", "value")
    apply_halves(t, log, {"large": "value > 1"}, feeds.history_into(table, "event_id", ["event_type"]))
    return changes.scd2_versions(table.read())


@query("stm_06_stream_join", """
    WITH r AS (SELECT user_id, event_type, date_trunc('hour', ts) AS hour, value FROM events),
    c AS (SELECT user_id, hour, count(*) AS clicks FROM r WHERE event_type = 'click' GROUP BY 1, 2),
    v AS (SELECT user_id, hour, count(*) AS views FROM r WHERE event_type = 'view' GROUP BY 1, 2)
    SELECT CAST(c.user_id AS VARCHAR) AS "deviceId", c.hour AS hour, clicks, views
    FROM c JOIN v ON c.user_id = v.user_id AND c.hour = v.hour
    WHERE c.hour + INTERVAL 62 MINUTE <= (SELECT least(max(ts) FILTER (WHERE event_type = 'click'),
        max(ts) FILTER (WHERE event_type = 'view')) FROM events)""")
def stream_join(t):
    """Hourly readings of two feeds joined as streams; hours still open are not emitted."""
    def hourly(kind: str, name: str):
        feed = event_stream(t).filter(F.col("topic") == kind).withWatermark("timestamp", feeds.LATENESS)
        counted = feed.groupBy(F.window("timestamp", "1 hour"), "deviceId").agg(F.count("*").alias(name))
        return counted

    joined = correlate(hourly("click", "clicks"), hourly("view", "views"), "deviceId", "window")
    stored = drain(t, joined, "joined")
    hours = stored.select("deviceId", F.col("window.start").alias("hour"), "clicks", "views")
    return without_zone(hours, "hour")


@query("stm_06_raw_readings", """
    SELECT c.event_id AS left_id, v.event_id AS right_id
    FROM events c JOIN events v ON c.user_id = v.user_id AND c.event_type = 'click' AND v.event_type = 'view'
    AND c.ts BETWEEN v.ts - INTERVAL 1800 SECOND AND v.ts + INTERVAL 1800 SECOND""")
def raw_readings(t):
    """Readings of two feeds paired as streams, no more than half an hour apart."""
    def feed(kind: str, name: str):
        one = event_stream(t).filter(F.col("topic") == kind).withWatermark("timestamp", feeds.LATENESS)
        return one.select(F.col("event_id").alias(name), "deviceId", "timestamp")

    joined = correlate_within(feed("click", "left_id"), feed("view", "right_id"), "deviceId", "timestamp", 1800)
    return drain(t, joined.select("left_id", "right_id"), "paired")


FEED_NAMES = ", ".join(f"{name}.speed AS {name}_speed" for name in TOPICS)
FEED_JOINS = " ".join(
    f"{'JOIN' if i else 'FROM'} (SELECT * FROM daily WHERE event_type = '{name}') {name}" + (" USING (user_id, day)" if i else "")
    for i, name in enumerate(TOPICS)
)


@query("stm_06_five_feeds", f"""
    WITH daily AS (SELECT user_id, event_type, date_trunc('day', ts) AS day, round(sum(value), 6) AS speed
                   FROM events GROUP BY 1, 2, 3)
    SELECT CAST(user_id AS VARCHAR) AS "deviceId", CAST(day AS TIMESTAMP) AS "timestamp", {FEED_NAMES} {FEED_JOINS}""")
def five_feeds(t):
    """A reading of every device and day in five topics, which chained stream joins bring together.

    The days arrive in order, those of the second half of the month after a restart.
    """
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).alias("timestamp")
    daily = t.events.groupBy(F.col("user_id").cast("string").alias("deviceId"), day, "event_type").agg(F.round(F.sum("value"), 6).alias("speed"))
    topics, out, spark = t.scratch("topics"), t.scratch("five"), keeping_state(t)
    message = F.to_json(F.struct("deviceId", "timestamp", "speed"), MICROSECONDS).alias("value")
    for half in ("timestamp < TIMESTAMP '2024-01-16 00:00:00 UTC'", "timestamp >= TIMESTAMP '2024-01-16 00:00:00 UTC'"):
        daily.filter(half).select(message, F.col("event_type").alias("feed")).write.mode("append").partitionBy("feed").text(topics)
        streams = feeds.read_feeds(
            spark, "text", lambda name: {"path": f"{topics}/feed={name}"},
            dict.fromkeys(TOPICS, "deviceId STRING, timestamp TIMESTAMP, speed DOUBLE"),
        )
        joined = correlate_all(streams, "deviceId", "timestamp")
        feeds.await_all([feeds.write_feed(joined, f"{out}/data", f"{out}/checkpoint", drain=True)])
    return without_zone(t.spark.read.schema(joined.schema).parquet(f"{out}/data"), "timestamp")


@query("win_06_streamed_speed", SPEED_SQL + """
    SELECT event_id, CAST(user_id AS VARCHAR) AS "deviceId", speed, CAST(sum(speed) OVER w AS BIGINT) AS odometer,
           row_number() OVER w AS step, round(avg(speed) OVER w, 6) AS average_speed
    FROM speeds WHERE ts + INTERVAL 2 MINUTE <= (SELECT max(ts) FROM events)
    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def streamed_speed(t):
    """Pulses of devices in two runs with a restart between; those inside the watermark still wait."""
    arriving, out = t.scratch("pulses"), t.scratch("traced")
    spark = keeping_state(t)
    for half in ("ts < TIMESTAMP_NTZ '2024-01-16'", "ts >= TIMESTAMP_NTZ '2024-01-16'"):
        t.events.filter(half).write.mode("append").parquet(arriving)
        stream = readings(spark.readStream.schema(EVENTS).parquet(arriving)).withWatermark("timestamp", feeds.LATENESS)
        delta = F.when(F.col("topic") == "click", 5).when(F.col("topic") == "error", -5).otherwise(0)
        traced = devices.speed_stream(stream, "deviceId", "timestamp", "event_id", delta)
        feeds.await_all([feeds.write_feed(traced, f"{out}/data", f"{out}/checkpoint", drain=True)])
    stored = t.spark.read.schema(traced.schema).parquet(f"{out}/data")
    return stored.drop("timestamp").withColumn("average_speed", F.round("average_speed", 6))


@query("stm_07_minute_average", """
    SELECT CAST(user_id AS VARCHAR) AS "deviceId", date_trunc('minute', ts) AS window_start,
           round(avg(value), 6) AS avg_speed, count(*) AS readings
    FROM events WHERE date_trunc('minute', ts) + INTERVAL 3 MINUTE <= (SELECT max(ts) FROM events)
    GROUP BY 1, 2""")
def minute_average(t):
    """Closed windows only: append mode holds back the minutes inside the watermark."""
    feed = event_stream(t).withWatermark("timestamp", feeds.LATENESS)
    stored = drain(t, feeds.minute_average(feed, "speed"), "minutes")
    return without_zone(stored, "window_start").withColumn("avg_speed", F.round("avg_speed", 6))
