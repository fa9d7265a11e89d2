"""Sliced windows against plain windows and a sequential fold."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.operators import ordered
from tidemill.session import stored

QUICK = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def numbers(df, by, tie):
    return sorted(tuple(r) for r in df.select(tie, "n", "r", "d").collect())


def check_ranks(df, by, order, tie, descending, section_rows):
    key = F.col(order).desc() if descending else F.col(order).asc()
    plain = Window.partitionBy(*by).orderBy(key)
    expected = df.withColumns({
        "n": F.row_number().over(plain.orderBy(key, F.col(tie))),
        "r": F.rank().over(plain), "d": F.dense_rank().over(plain),
    })
    got = ordered.ranked(
        df, by, order, tie=tie, descending=descending, section_rows=section_rows, row_number="n", rank="r", dense_rank="d"
    )
    assert numbers(got, by, tie) == numbers(expected, by, tie)


@pytest.mark.parametrize("kind", ["double", "bigint", "string", "date", "timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("descending", [False, True])
def test_ranks_with_a_hot_value(spark, kind, descending):
    """A third of the rows share one value, a tenth are null, one group holds most rows."""
    rng = random.Random(7)
    rows = [
        (i, "hot" if rng.random() < 0.7 else rng.choice("abc"),
         None if rng.random() < 0.1 else 500 if rng.random() < 0.33 else rng.randrange(1000))
        for i in range(1500)
    ]
    df = spark.createDataFrame(rows, "id INT, g STRING, v INT")
    value = {
        "double": F.col("v") / 8, "bigint": F.col("v").cast("bigint") * (1 << 50),
        "string": F.concat(F.lit("prefix#é"), F.lpad(F.col("v").cast("string"), 9, "0")),
        "date": F.date_add(F.lit("2020-01-01").cast("date"), F.col("v")),
        "timestamp": F.timestamp_micros(F.col("v").cast("bigint") * 1000003),
        "timestamp_ntz": F.timestamp_micros(F.col("v").cast("bigint") * 1000003).cast("timestamp_ntz"),
    }[kind]
    check_ranks(df.withColumn("v", value), ["g"], "v", "id", descending, 100)


@QUICK
@given(st.lists(st.tuples(st.sampled_from("ab"), st.none() | st.sampled_from([0.0, 1.0, 1.5, float("nan"), -2.0])), max_size=40))
def test_ranks_of_any_rows(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id INT, g STRING, v DOUBLE")
    check_ranks(df, ["g"], "v", "id", True, 5)


@pytest.mark.parametrize("section_rows", [60, 300, 2000])
def test_dense_keys(spark, section_rows):
    df = spark.range(1000).select((F.col("id") * 37 % 1009).alias("k"))
    got = ordered.dense_keys(df, "k", "key", after=F.lit(100), section_rows=section_rows).orderBy("k").collect()
    assert [r.key for r in got] == list(range(101, 1101))


def test_batches(spark):
    got = ordered.batch_numbers(spark.range(25), "id", 10, "batch", section_rows=4).orderBy("id").collect()
    assert [r.batch for r in got] == [1] * 10 + [2] * 10 + [3] * 5


class Car:
    """The state a device moves through, one pulse at a time."""

    def __init__(self):
        self.speed = self.odometer = self.time = 0

    def pulse(self, delta):
        self.speed = max(0, self.speed + delta)
        self.odometer += self.speed
        self.time += 1
        return self.speed, self.odometer, self.time, self.odometer / self.time


def traced(spark, sequences, section_rows):
    rows = [(d, i, delta) for d, deltas in sequences.items() for i, delta in enumerate(deltas)]
    df = spark.createDataFrame(rows, "device STRING, at INT, delta INT")
    out = ordered.speed_trace(df, ["device"], ["at"], F.col("delta"), section_rows)
    return {(r.device, r["at"]): (r.speed, r.odometer, r.step, r.average_speed) for r in out.collect()}


def test_speed_golden(spark):
    got = traced(spark, {"up": [5] * 5 + [-5] * 3, "stopped": [-5] * 5}, 3)
    assert got["up", 7][0] == 10 and got["stopped", 4][0] == 0


@QUICK
@given(st.dictionaries(st.sampled_from("ab"), st.lists(st.sampled_from([5, -5, 0]), min_size=1, max_size=30), min_size=1),
       st.integers(2, 9))
def test_speed_equals_the_fold(spark, sequences, section_rows):
    got = traced(spark, sequences, section_rows)
    for device, deltas in sequences.items():
        car = Car()
        for i, delta in enumerate(deltas):
            assert got[device, i] == pytest.approx(car.pulse(delta))


@pytest.mark.parametrize("section_rows", [10, 40, 120])
def test_changes_of_a_large_group(spark, section_rows):
    """Group "a" is large; a third of its rows share one moment; a null key is a group too."""
    rng = random.Random(3)
    moments = [(50 if rng.random() < 0.4 else i) for i in range(300)]
    rows = [(rng.choice(["a", "a", "a", "a", "b", None]), m, i, rng.choice("xxxy")) for i, m in enumerate(moments)]
    df = spark.createDataFrame(rows, "g STRING, at INT, i INT, v STRING")
    window = Window.partitionBy("g").orderBy("at", "i")
    expected = df.withColumn("p", F.lag("v").over(window)).filter("NOT (p <=> v)").drop("p")
    expected = expected.withColumn("to", F.lead("at").over(window))
    got = ordered.changes_of_state(df, ["g"], ["at", "i"], F.col("v"), "to", section_rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    assert ordered.Sections(df, ["g"], [F.col("at"), F.col("i")], section_rows).cut


def test_a_long_unchanged_state_spans_sections(spark):
    df = spark.range(100).selectExpr("'a' g", "id at", "id BETWEEN 40 AND 89 v")
    got = ordered.changes_of_state(df, ["g"], ["at"], F.col("v"), "to", 7).orderBy("at").collect()
    assert [(r["at"], r.to) for r in got] == [(0, 40), (40, 90), (90, None)]


@pytest.mark.parametrize("value", [
    "CAST(NULL AS STRING)", "7", "double('nan')", "IF(id % 3 <> 0, CAST(5 AS DECIMAL(20, 2)), NULL)",
    "concat(IF(id % 2 = 0, 'https://a.example.com/very/long/path/', 'https://b.example.com/'), id)",
])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_no_section_exceeds_its_rows(spark, value, by):
    df = spark.range(3000).selectExpr("id", "'a' AS g", f"{value} AS v")
    sections = ordered.Sections(df, by, [F.col("v").desc()], 200)
    sizes = [r["count"] for r in sections.rows.groupBy(ordered.SECTION).count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 200


@pytest.mark.parametrize("sample, ranges", [(1, 10_000), (1, 3), (100, 3)])
def test_sections_hold_their_bound_whatever_the_ranges(spark, monkeypatch, sample, ranges):
    """Few sample points, or far fewer ranges than sections, change neither the bound nor the order, and cost no second write."""
    written = []
    monkeypatch.setattr(ordered, "stored", lambda df, label: written.append(label) or stored(df, label))
    monkeypatch.setattr(ordered, "RANGES", ranges)
    spark.conf.set("spark.sql.execution.rangeExchange.sampleSizePerPartition", sample)
    try:
        df = spark.range(5000).selectExpr("id", "CAST(id * 7919 % 5000 AS INT) AS v")
        sections = ordered.Sections(df, [], [F.col("v").asc()], 100)
        spans = sections.rows.groupBy(ordered.SECTION).agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
        spans = spans.orderBy(ordered.SECTION).collect()
    finally:
        spark.conf.unset("spark.sql.execution.rangeExchange.sampleSizePerPartition")
    assert written == ["ordered", "sections"]
    assert max(r.n for r in spans) <= 100 and sum(r.n for r in spans) == 5000
    assert all(p.b < q.a for p, q in zip(spans, spans[1:]))


@pytest.mark.parametrize("rows", [[("a", None, "x")], [("a", 1, "x"), ("a", 1, "y")]])
@pytest.mark.parametrize("section_rows", [1, 100])
def test_an_open_order_is_an_error(spark, rows, section_rows):
    df = spark.createDataFrame([*rows, ("a", 5, "x"), ("b", 1, "x")], "g STRING, at INT, v STRING")
    with pytest.raises(Exception, match="in any order"):
        ordered.changes_of_state(df, ["g"], ["at"], F.col("v"), "to", section_rows).collect()
