"""Streams drained over small files: typed feeds, restarts, late rows, joins and changes."""

import json
import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemill.operators import changes
from tidemill.operators.changes import scd2_versions
from tidemill.operators.joins import correlate, correlate_all
from tidemill.operators.ordered import speed_trace
from tidemill.plans import REGISTRY
from tidemill.schemas import FEEDS
from tidemill.session import stateful
from tidemill.sources.tables import BucketTable
from tidemill.streaming import devices, feeds


def say(folder, name, *messages):
    folder.mkdir(parents=True, exist_ok=True)
    lines = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    (folder / name).write_text("\n".join(lines) + "\n")


def run(query):
    feeds.await_all([query])


def test_five_feeds(spark, tmp_path):
    at = "2024-05-01T10:00:00.123456"
    for name in FEEDS:
        say(tmp_path / name, "1.json", {"id": "u1", "deviceId": "d1", "timestamp": at, "location": [51.5, -0.12],
                                        "speed": 12.5, "year": 2024, "humidity": 40}, "no json")
    streams = feeds.read_feeds(spark, "text", lambda n: {"path": str(tmp_path / n)})
    assert list(streams) == ["vehicle", "gps", "traffic", "weather", "emergency"]
    feeds.await_all(feeds.write_feeds(streams, str(tmp_path / "out"), drain=True).values())
    for name, schema in FEEDS.items():
        got = spark.read.schema(schema).parquet(str(tmp_path / "out/data" / name))
        assert got.count() == 2 and got.filter("id IS NULL AND deviceId IS NULL").count() == 1
        assert got.filter("timestamp = TIMESTAMP '2024-05-01 10:00:00.123456'").count() == 1
    vehicle = spark.read.schema(FEEDS["vehicle"]).parquet(str(tmp_path / "out/data/vehicle"))
    row = vehicle.filter("id = 'u1'").select("location", feeds.parse_location(F.col("location")).alias("at")).first()
    assert row.location == "[51.5,-0.12]" and tuple(row["at"]) == (51.5, -0.12)


def test_late_rows_and_restart(spark, tmp_path):
    """Nothing in the sink consumes the watermark, so a late row still arrives; files are read once."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    for batch, moments in enumerate((["10:00:00", "11:00:00"], ["09:00:00"])):
        say(source, f"{batch}.json", *[{"id": m, "timestamp": f"2024-05-01T{m}"} for m in moments])
        for _ in range(2):
            stream = feeds.read_topic(spark, "text", {"path": str(source)}, FEEDS["gps"])
            run(feeds.write_feed(stream, f"{out}/data", f"{out}/checkpoint", drain=True))
    got = spark.read.schema(FEEDS["gps"]).parquet(f"{out}/data")
    assert sorted(r.id for r in got.collect()) == ["09:00:00", "10:00:00", "11:00:00"]


def test_feeds_meet_on_device_and_time(spark, tmp_path):
    for i in range(4):
        at = f"2024-05-01T10:0{i}:00"
        say(tmp_path / "vehicle", f"{i}.json", {"id": f"v{i}", "deviceId": "d", "timestamp": at, "speed": i})
        if i != 2:
            say(tmp_path / "gps", f"{i}.json", {"id": f"g{i}", "deviceId": "d", "timestamp": at, "vehicleType": "car"})
    streams = feeds.read_feeds(spark, "text", lambda n: {"path": str(tmp_path / n)}, {n: FEEDS[n] for n in ("vehicle", "gps")})
    joined = correlate(
        streams["vehicle"].select("deviceId", "timestamp", "speed"),
        streams["gps"].select("deviceId", "timestamp", "vehicleType"), "deviceId", "timestamp")
    run(feeds.write_feed(joined, str(tmp_path / "out"), str(tmp_path / "cp"), drain=True))
    got = spark.read.schema(joined.schema).parquet(str(tmp_path / "out"))
    assert sorted(r.speed for r in got.collect()) == [0.0, 1.0, 3.0]


def test_minutes(spark, tmp_path):
    rows = [{"deviceId": "d", "timestamp": f"2024-05-01T10:{m:02}:{s:02}", "speed": m + s} for m in range(6) for s in (0, 30)]
    say(tmp_path / "in", "1.json", *rows)
    stream = feeds.read_topic(spark, "text", {"path": str(tmp_path / "in")}, FEEDS["gps"])
    averages = feeds.minute_average(stream, "speed")
    run(feeds.write_feed(averages, str(tmp_path / "out"), str(tmp_path / "cp"), drain=True))
    got = spark.read.schema(averages.schema).parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r.avg_speed, r.readings) for r in got] == [(15.0, 2), (16.0, 2), (17.0, 2)]


def arrive(spark, rows, schema, folder, rules, apply, checkpoint):
    """One file more for a stream, and a run over it."""
    df = spark.createDataFrame(rows, schema)
    df.coalesce(1).write.mode("append").parquet(folder)
    run(feeds.apply_changes(spark.readStream.schema(df.schema).parquet(folder), rules, apply, checkpoint))


RULES = {"rule1": "product_id IS NOT NULL", "rule2": "product_name IS NOT NULL"}


def test_streamed_changes(spark, tmp_path):
    table = BucketTable(spark, str(tmp_path / "dim"), ["product_id"], 4)
    batches = [("P1", "a", 2), ("P1", "b", 1), ("P2", None, 1), (None, "x", 1)], [("P1", "A", 3), ("P3", "c", 3)], [("P1", "late", 0)]
    for batch in batches:
        arrive(spark, batch, "product_id STRING, product_name STRING, seq INT", str(tmp_path / "in"), RULES,
               feeds.upsert_into(table, "seq"), str(tmp_path / "cp"))
    assert sorted(map(tuple, table.read().collect())) == [("P1", "A", 3), ("P3", "c", 3)]


def files(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_streamed_history_of_late_and_replayed_batches(spark, tmp_path):
    """Any order and any replay give the history of the whole log, and only touched buckets are rewritten."""
    r = random.Random(8)
    log = [(f"P{r.choice([0, 0, 0, *range(30)])}", r.choice("aab"), i) for i in range(400)]
    batches = [log[200:300], log[:150], [("P0", "z", 900)], log[150:200] + log[100:150], log[300:]]
    table = BucketTable(spark, str(tmp_path / "dim"), ["product_id"], 16)
    apply = feeds.history_into(table, "seq", ["product_name"])
    schema, before = "product_id STRING, product_name STRING, seq INT", {}
    for batch in batches:
        arrive(spark, batch, schema, str(tmp_path / "in"), RULES, apply, str(tmp_path / "cp"))
        if len(batch) == 1:
            changed = {name for name in before | files(tmp_path / "dim") if before.get(name) != files(tmp_path / "dim").get(name)}
            touched = {name.split("/")[1] for name in changed if name.startswith("buckets=")}
            assert len(touched) == 1
        before = files(tmp_path / "dim")
    expected = []
    log.append(("P0", "z", 900))
    for key in {k for k, _, _ in log}:
        own = sorted((i, v) for k, v, i in log if k == key)
        versions = [(i, v) for n, (i, v) in enumerate(own) if n == 0 or own[n - 1][1] != v]
        ends = [i for i, _ in versions[1:]] + [None]
        expected += [(key, v, i, end, end is None) for (i, v), end in zip(versions, ends)]
    result = lambda: sorted(map(tuple, scd2_versions(table.read()).collect()))
    assert result() == sorted(expected)
    replayed = spark.createDataFrame(batches[0], schema)
    table.merge(replayed, 0, lambda *_: pytest.fail("applied twice"))
    assert result() == sorted(expected) and files(tmp_path / "dim") == before


def test_a_merge_cut_short_is_carried_on(spark, tmp_path, monkeypatch):
    table = BucketTable(spark, str(tmp_path / "t"), ["k"], 4)
    frame = lambda *rows: spark.createDataFrame(rows, "k INT, v STRING, n INT")
    newer = lambda old, new: changes.upsert_newer(old, new, ["k"], "n")
    assert table.merge(frame((1, "a", 1), (2, "b", 1), (None, "n", 1)), 0, newer)
    publish = BucketTable._publish
    monkeypatch.setattr(BucketTable, "_publish", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.merge(frame((1, "A", 2), (3, "c", 1)), 1, newer)
    monkeypatch.setattr(BucketTable, "_publish", publish)
    assert sorted(r.v for r in table.read().collect()) == ["a", "b", "n"]
    assert not table.merge(frame((1, "A", 2), (3, "c", 1)), 1, newer)
    assert sorted(r.v for r in table.read().collect()) == ["A", "b", "c", "n"]
    assert table.merge(frame(), 2, newer) and table.merge(frame((None, "N", 2)), 0, newer, writer="other")
    assert sorted(r.v for r in table.read().collect()) == ["A", "N", "b", "c"]


def test_a_hot_key_is_written_by_several_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rows = spark.range(30000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS n", "sha2(CAST(id AS STRING), 256) AS v")
        table = BucketTable(spark, str(tmp_path / "t"), ["k"], 2)
        table.merge(rows, 0, lambda old, new: new)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert table.read().count() == 30000
    hot = (tmp_path / "t/buckets=2").glob("_bucket=*")
    assert max(len(list(f.glob("*.parquet"))) for f in hot) > 1


def test_five_feeds_meet_and_leave_the_state(spark, tmp_path):
    """One file per feed and micro-batch; the state of every join shrinks as the watermark moves on."""
    names, minutes = list(FEEDS), [0, 1, 2, 60, 61, 120]
    for batch, minute in enumerate(minutes):
        at = f"2024-05-01T{10 + minute // 60}:{minute % 60:02}:00"
        for name in names:
            absent = name == "weather" and minute == 1
            own = [] if absent else [{"id": f"{name}{d}", "deviceId": f"d{d}", "timestamp": at} for d in range(20)]
            say(tmp_path / name, f"{batch}.json", *own, {"id": "x", "deviceId": f"only {name}", "timestamp": at})
    streams = feeds.read_feeds(spark, "text", lambda n: {"path": str(tmp_path / n), "maxFilesPerTrigger": 1})
    joined = correlate_all({n: s.select("deviceId", "timestamp", "id") for n, s in streams.items()}, "deviceId", "timestamp")
    query = feeds.write_feed(joined, str(tmp_path / "out"), str(tmp_path / "cp"), drain=True)
    run(query)
    got = spark.read.schema(joined.schema).parquet(str(tmp_path / "out"))
    assert got.columns == ["deviceId", "timestamp", *[f"{n}_id" for n in names]]
    found = Counter((r.deviceId, r.timestamp.hour * 60 + r.timestamp.minute - 600, r.emergency_id) for r in got.collect())
    assert found == Counter((f"d{d}", m, f"emergency{d}") for m in minutes if m != 1 for d in range(20))
    held = [[o.numRowsTotal for o in p.stateOperators] for p in query.recentProgress]
    assert len(held[0]) == 4 and max(h[0] for h in held) > 120
    assert all(last <= most / 2 for last, most in zip(held[-1], map(max, zip(*held))))


def pulse_rows(r, n, devices=5):
    """Pulses out of order within the lateness, several at one moment."""
    return [(f"d{r.choice([0, 0, *range(devices)])}", 1_700_000_000 + i // 2 + r.randrange(50), i, r.choice([5, -5, 0, None])) for i in range(n)]


def speeds(spark, folder, out, rows, batch, idle=None):
    """Append a file of pulses, run the stream once, and give what it wrote so far."""
    own = stateful(spark, 2)
    df = own.createDataFrame(rows, "device STRING, s LONG, i LONG, delta INT")
    df.coalesce(1).write.mode("append").parquet(folder)
    stream = own.readStream.schema(df.schema).parquet(folder).withColumn("at", F.timestamp_seconds("s")).withWatermark("at", "2 minutes")
    run(feeds.write_feed(devices.speed_stream(stream, "device", "at", "i", F.col("delta"), idle), f"{out}/data", f"{out}/cp", drain=True))
    return spark.read.parquet(f"{out}/data").collect()


def test_streamed_speed_equals_the_batch_trace(spark, tmp_path):
    rows = pulse_rows(random.Random(5), 600)
    for batch, a in enumerate(range(0, 600, 200)):
        got = speeds(spark, str(tmp_path / "in"), str(tmp_path / "out"), rows[a : a + 200], batch)
    late = [("d0", 1_600_000_000, 9000, 5)]
    got = speeds(spark, str(tmp_path / "in"), str(tmp_path / "out"), late, 3)
    closed = max(s for _, s, _, _ in rows) - 120
    df = spark.createDataFrame(rows, "device STRING, s LONG, i LONG, delta INT").withColumn("at", F.timestamp_seconds("s"))
    expected = speed_trace(df, ["device"], ["at", "i"], F.col("delta")).filter(F.col("s") <= closed)
    names = ["device", "i", "speed", "odometer", "step", "average_speed"]
    assert len(got) > 300
    assert sorted(tuple(r[n] for n in names) for r in got) == sorted(tuple(r[n] for n in names) for r in expected.collect())


def test_idle_devices_are_forgotten(spark, tmp_path):
    """A device without pulses for a minute begins anew, one that goes on does not."""
    start = 1_700_000_000
    rows = [("a", start, 0, 5), ("b", start, 1, 5)], [("b", start + 50, 2, 5), ("x", start + 400, 3, 0)], \
        [("a", start + 400, 4, 5), ("b", start + 401, 5, 5), ("x", start + 900, 6, 0)]
    for batch, part in enumerate(rows):
        got = speeds(spark, str(tmp_path / "in"), str(tmp_path / "out"), part, batch, idle=60_000)
    found = {r.i: (r.speed, r.step) for r in got}
    assert found[0] == (5, 1) and found[2] == (10, 2) and found[4] == (5, 1) and found[5] == (5, 1)


def test_devices_share_stored_values(spark, tmp_path):
    """Calls to the state store follow the shards, not the devices; devices without an id are one device."""
    own = stateful(spark, 2)
    rows = [(None if d == 7 else f"d{d}", 1_700_000_000 + 10 * k, 10 * d + k, 5) for d in range(600) for k in range(3)]
    own.createDataFrame([*rows, ("end", 1_700_009_000, -1, 0)], "device STRING, s LONG, i LONG, delta INT").write.parquet(str(tmp_path / "in"))
    stream = own.readStream.schema("device STRING, s LONG, i LONG, delta INT").parquet(str(tmp_path / "in"))
    stream = stream.withColumn("at", F.timestamp_seconds("s")).withWatermark("at", "2 minutes")
    traced = devices.speed_stream(stream, "device", "at", "i", F.col("delta"))
    query = feeds.write_feed(traced, str(tmp_path / "out"), str(tmp_path / "cp"), drain=True)
    run(query)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.i, r.speed, r.odometer, r.step) for r in got) == sorted((10 * d + k, 5 * k + 5, (5, 15, 30)[k], k + 1) for d in range(600) for k in range(3))
    assert {r.device for r in got if r.i // 10 == 7} == {None}
    assert query.recentProgress[0].stateOperators[0].numRowsUpdated <= devices.SHARDS < 600


def test_state_is_spread_over_all_cores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemill.plans.streams.STATES", 1)
    spark.createDataFrame(
        [(i, i % 3, kind, 1.0, i) for i, kind in enumerate(("click", "view", "error") * 4)], "event_id LONG, user_id LONG, event_type STRING, value DOUBLE, d INT"
    ).selectExpr("event_id", "TIMESTAMP_NTZ '2024-01-14' + make_interval(0, 0, 0, 0, 0, 10 * d) AS ts", "user_id", "event_type", "value", "'{}' AS props").write.parquet(
        f"{tmp_path}/events.parquet")
    before = set(Path(spark.conf.get("spark.checkpoint.dir")).glob("tidemill/traced-*"))
    got = REGISTRY["win_06_streamed_speed"](spark, str(tmp_path)).collect()
    assert sorted(r.event_id for r in got) == list(range(11))
    (out,) = set(Path(spark.conf.get("spark.checkpoint.dir")).glob("tidemill/traced-*")) - before
    assert len([d for d in (out / "checkpoint/state/0").iterdir() if d.name.isdigit()]) == 4  # the cores of the session


def test_any_failing_feed_is_noticed(spark, tmp_path):
    say(tmp_path / "in", "1.json", {"id": "a"})
    stream = feeds.read_topic(spark, "text", {"path": str(tmp_path / "in")}, FEEDS["gps"])
    broken = stream.withColumn("id", F.raise_error(F.lit("broken")).cast("string"))
    queries = feeds.write_feeds({"broken": broken, "fine": stream}, str(tmp_path / "out"), drain=True)
    with pytest.raises(Exception, match="broken"):
        feeds.await_all(queries.values())
    assert not any(q.isActive for q in queries.values())


def test_kafka_options():
    assert feeds.kafka_options("broker:29092", "gps_data") == {
        "kafka.bootstrap.servers": "broker:29092", "subscribe": "gps_data", "startingOffsets": "earliest"}


def test_landing_keeps_the_first_schema(spark, tmp_path):
    landing, source = str(tmp_path / "landing"), str(tmp_path / "source")
    spark.range(3).withColumn("v", F.lit("a")).write.parquet(f"{source}/orders")
    feeds.ingest_files(spark, ["orders"], lambda n: f"{source}/{n}", landing)
    later = spark.range(3, 5).withColumn("v", F.lit("b")).withColumn("extra", F.lit(1))
    later.write.mode("append").parquet(f"{source}/orders")
    with pytest.raises(ValueError, match="new columns .'extra'"):
        feeds.ingest_files(spark, ["orders"], lambda n: f"{source}/{n}", landing)
    assert spark.read.parquet(f"{landing}/data/orders").count() == 3


def test_redelivered_messages_arrive_once(spark, tmp_path):
    """Three runs over a topic that repeats messages inside a file, in the next file and much later."""
    message = lambda i, minute: {"id": f"m{i}", "deviceId": "d", "timestamp": f"2024-05-01T{10 + minute // 60}:{minute % 60:02}:00"}
    deliveries = [[message(0, 0), message(1, 1), message(0, 0)], [message(1, 1), message(2, 2), message(0, 0)],
                  [message(3, 90)], [message(0, 0), message(2, 2), message(3, 90), message(4, 89)]]
    for batch, part in enumerate(deliveries):
        say(tmp_path / "in", f"{batch}.json", *part)
        stream = feeds.once(feeds.read_topic(spark, "text", {"path": str(tmp_path / "in")}, FEEDS["gps"]))
        run(feeds.write_feed(stream, str(tmp_path / "out"), str(tmp_path / "cp"), drain=True))
    got = spark.read.schema(FEEDS["gps"]).parquet(str(tmp_path / "out")).collect()
    assert sorted(r.id for r in got) == ["m0", "m1", "m2", "m3", "m4"]


def test_unknown_fields_are_rescued_and_promoted(spark, tmp_path):
    source, landing = str(tmp_path / "source"), feeds.Landing(spark, str(tmp_path / "landing"))
    spark.range(3).withColumn("v", F.lit("a")).write.parquet(source)
    landing.land(source)
    assert landing.read().columns == ["id", "v", "_rescued_data"]
    more = spark.range(3, 5).selectExpr("id", "'b' AS V", "id * 2 AS extra", "named_struct('x', id) AS deep", "DATE'2024-05-01' AS `a day`")
    more.write.mode("append").parquet(source)
    spark.range(5, 6).write.mode("append").parquet(source)
    landing.land(source)
    landing.land(source)
    rows = {r.id: r for r in landing.read().select("id", "v", F.col("_rescued_data").cast("string").alias("more")).collect()}
    assert len(rows) == 6 and rows[4].v == "b" and rows[5].v is None and rows[0].more is None
    assert json.loads(rows[4].more) == {"extra": 8, "deep": {"x": 4}, "a day": "2024-05-01"}
    landing.widen("extra BIGINT, `a day` DATE")
    spark.range(6, 7).selectExpr("id", "'c' AS v", "7L AS extra").write.mode("append").parquet(source)
    landing.land(source)
    rows = {r.id: r for r in landing.read().collect()}
    assert [rows[i].extra for i in range(7)] == [None, None, None, 6, 8, None, 7]
    assert str(rows[3]["a day"]) == "2024-05-01" and landing.read().filter("_rescued_data IS NOT NULL").count() == 2
    spark.range(7, 8).selectExpr("id", "5 AS v").write.mode("append").parquet(source)
    with pytest.raises(Exception, match="another type"):
        landing.land(source)
