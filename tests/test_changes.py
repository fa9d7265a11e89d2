"""Upserts, slowly changing dimensions and versioned tables."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemill.operators import changes
from tidemill.sources.tables import FolderTable

pytestmark = pytest.mark.usefixtures("small_sections")
QUICK = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
T0 = datetime(2025, 1, 1)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def airports(spark):
    """Base, increment and changed batches with the sizes of the shipped ones."""
    make = lambda ids, city: spark.createDataFrame(
        [(f"A{i:03}", f"Airport {i}", f"{city}{i}", "VN") for i in ids],
        "airport_id STRING, airport_name STRING, city STRING, country STRING",
    )
    return [
        make(range(1, 51), "C"), make(range(51, 56), "C"),
        make([23, 39, 6], "Moved").unionByName(make([56, 57, 58], "C")),
    ]


def test_three_batches(spark):
    batches = airports(spark)
    flat = changes.fold_batches(batches, ["airport_id"])
    assert flat.count() == 58 and flat.filter("city LIKE 'Moved%'").count() == 3
    history = changes.fold_history(batches, ["airport_id"])
    assert history.count() == 61 and history.filter("is_current").count() == 58
    closed = history.filter("NOT is_current").select("airport_id", "valid_from", "valid_to").collect()
    assert sorted(map(tuple, closed)) == [("A006", 0, 2), ("A023", 0, 2), ("A039", 0, 2)]


@QUICK
@given(st.lists(st.tuples(st.integers(1, 4), st.sampled_from(["x", "y", None])), max_size=30), st.integers(2, 9))
def test_history_invariants(spark, log, section_rows):
    df = spark.createDataFrame([(k, i, v) for i, (k, v) in enumerate(log)], "k INT, seq INT, v STRING")
    versions = changes.scd2(df, ["k"], ["seq"], ["v"], section_rows).collect()
    for key in {k for k, _ in log}:
        mine = sorted((r for r in versions if r.k == key), key=lambda r: r.valid_from)
        assert [r.is_current for r in mine] == [False] * (len(mine) - 1) + [True]
        assert [r.valid_to for r in mine[:-1]] == [r.valid_from for r in mine[1:]]
        wanted = [v for i, (k, v) in enumerate(log) if k == key]
        kept = [v for i, v in enumerate(wanted) if i == 0 or v != wanted[i - 1]]
        assert [r.v for r in mine] == kept


@QUICK
@given(st.dictionaries(st.integers(1, 9) | st.none(), st.integers(0, 99), max_size=6),
       st.dictionaries(st.integers(1, 9) | st.none(), st.integers(0, 99), max_size=6))
def test_upsert_twice_is_once(spark, old, new):
    schema = "k INT, v INT"
    target = spark.createDataFrame(list(old.items()), schema) if old else spark.createDataFrame([], schema)
    source = spark.createDataFrame(list(new.items()), schema) if new else spark.createDataFrame([], schema)
    once = changes.upsert(target, source, ["k"])
    assert dict(map(tuple, once.collect())) == {**old, **new}
    assert rows_of(changes.upsert(once, source, ["k"])) == rows_of(once)


def test_upsert_rejects_repeated_keys(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k INT, v STRING")
    with pytest.raises(ValueError):
        changes.upsert(twice.limit(0), twice, ["k"])
    assert changes.upsert_latest(None, twice, ["k"], F.desc("v")).collect()[0].v == "b"


def test_scd1_reload_keeps_keys(spark):
    now = lambda day: F.lit(f"2025-01-0{day} 00:00:00").cast("timestamp_ntz")
    first = spark.createDataFrame([("C2", "b"), ("C1", "a"), ("C1", "a")], "customer_id STRING, city STRING")
    dim = changes.scd1(None, first, "customer_id", "DimCustomerKey", now(1))
    later = spark.createDataFrame([("C2", "B"), ("C0", "z")], "customer_id STRING, city STRING")
    dim = changes.scd1(dim, later, "customer_id", "DimCustomerKey", now(2))
    got = {r.customer_id: (r.DimCustomerKey, r.city, r.create_date.day, r.update_date.day) for r in dim.collect()}
    assert got == {"C1": (1, "a", 1, 1), "C2": (2, "B", 1, 2), "C0": (3, "z", 2, 2)}


def test_incremental_load(spark):
    rows = spark.createDataFrame([(1, T0), (2, T0 + timedelta(1))], "id INT, updated_at TIMESTAMP_NTZ")
    assert changes.newer_than_stored(rows, None, "updated_at").count() == 2
    assert changes.newer_than_stored(rows, rows.limit(0), "updated_at").count() == 2
    assert [r.id for r in changes.newer_than_stored(rows, rows.filter("id = 1"), "updated_at").collect()] == [2]


def test_delete_keeps_unknown(spark):
    rows = spark.createDataFrame([(1,), (None,), (2,)], "v INT")
    assert rows_of(changes.delete_where(rows, F.col("v") == 1)) == [(2,), (None,)]


def test_folder_table(spark, tmp_path):
    table = FolderTable(spark, str(tmp_path / "zone"))
    assert table.versions() == []
    zones = spark.createDataFrame([(1, "EWR"), (2, "Queens")], "LocationID INT, Borough STRING")
    table.write(zones)
    table.write(changes.update_where(table.read(), F.col("LocationID") == 1, Borough=F.lit("EMR")))
    table.write(changes.delete_where(table.read(), F.col("LocationID") == 1))
    assert rows_of(table.read()) == [(2, "Queens")] and rows_of(table.read(1)) == [(1, "EMR"), (2, "Queens")]
    table.write(table.read(0))
    assert rows_of(table.read()) == rows_of(zones)
    assert rows_of(table.sizes()) == [(0, 2), (1, 2), (2, 1), (3, 2)]
    (tmp_path / "zone/version=9").mkdir()  # a write that did not finish
    assert table.versions() == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        table.read(7)


def test_a_null_member_keeps_its_key(spark):
    now = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    feed = spark.createDataFrame([(None, "x"), ("C1", "a")], "id STRING, city STRING")
    dim = changes.scd1(None, feed, "id", "key", now)
    for _ in range(3):
        dim = changes.scd1(dim, feed, "id", "key", now)
    assert {r.id: r.key for r in dim.collect()} == {None: 1, "C1": 2} and dim.count() == 2


def test_a_null_link_is_refused(spark):
    stored = spark.createDataFrame([("a", 1)], "link STRING, n INT")
    feed = spark.createDataFrame([(None, 2), ("b", 2)], "link STRING, n INT")
    with pytest.raises(Exception, match="is null"):
        changes.insert_absent(stored, feed, ["link"], F.col("n")).collect()


@QUICK
@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from("xy")), min_size=1, max_size=14), st.integers(1, 4), st.randoms())
def test_history_by_batches_is_that_of_the_whole_log(spark, log, size, rng):
    """Any order of batches, repeats included, gives the versions of the whole log."""
    rows = [(k, i, v) for i, (k, v) in enumerate(log)]
    schema = "k INT, seq INT, v STRING"
    whole = changes.scd2(spark.createDataFrame(rows, schema), ["k"], ["seq"], ["v"])
    parts = [rows[i : i + size] for i in range(0, len(rows), size)][:4]
    if sum(map(len, parts)) < len(rows):
        parts.append(rows[4 * size :])
    rng.shuffle(parts)
    stored = None
    for part in [*parts, parts[0]]:
        step = changes.scd2_step(stored, spark.createDataFrame(part, schema), ["k"], "seq", ["v"])
        stored = spark.createDataFrame(step.collect(), step.schema)
    assert rows_of(changes.scd2_versions(stored)) == rows_of(whole)


def test_upsert_newer(spark):
    make = lambda *rows: spark.createDataFrame(list(rows), "k INT, seq INT, v STRING")
    table = changes.upsert_newer(None, make((1, 5, "a"), (1, 4, "b"), (None, 1, "n")), ["k"], "seq")
    table = changes.upsert_newer(table, make((1, 3, "late"), (2, 1, "c"), (1, 5, "a")), ["k"], "seq")
    assert rows_of(table) == [(1, 5, "a"), (2, 1, "c"), (None, 1, "n")]
    for bad in (make((1, 5, "other")), make((1, None, "x"))):
        with pytest.raises(Exception, match="same or no"):
            changes.upsert_newer(table, bad, ["k"], "seq").collect()


def test_flights_golden(spark):
    """The sizes of the shipped flight batches: 113 keys, 118 versions."""
    make = lambda ids, line: spark.createDataFrame([(f"F{i:04}", line) for i in ids], "flight_id STRING, airline STRING")
    batches = [make(range(1, 101), "A"), make(range(101, 111), "A"),
               make([45, 5, 3, 32, 52], "B").unionByName(make([111, 112, 113], "A"))]
    assert changes.fold_batches(batches, ["flight_id"]).count() == 113
    history = changes.fold_history(batches, ["flight_id"])
    assert history.count() == 118 and history.filter("is_current").count() == 113
