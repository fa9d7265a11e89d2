"""Key filters beside bucket tables."""

import pytest
from pyspark.sql import functions as F
from tidemill.sources.tables import BucketTable, KeyFilter, insert_absent


def pair(spark, path, blocks=8):
    return BucketTable(spark, f"{path}/rows", ["k", "part"], 8), KeyFilter(spark, f"{path}/filter", ["k", "part"], blocks, 4)


def frame(spark, ids, v):
    return spark.createDataFrame([(i, f"p{i % 3}", v) for i in ids], "k LONG, part STRING, v STRING")


def test_only_absent_keys_are_inserted_and_few_buckets_read(spark, tmp_path):
    table, known = pair(spark, tmp_path)
    assert insert_absent(table, known, frame(spark, [*range(300), 5, 5], "a"), 0) == []
    assert insert_absent(table, known, frame(spark, range(1000, 1200), "b"), 1) == []
    read = insert_absent(table, known, frame(spark, [7, *range(2000, 2050)], "c"), 2)
    assert len(read) == 1
    rows = {r.k: r.v for r in table.read().collect()}
    assert rows == {i: v for ids, v in ((range(2000, 2050), "c"), (range(1000, 1200), "b"), (range(300), "a")) for i in ids}
    assert table.read().count() == 550
    scan = table.read(read)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in scan or "PartitionFilters: [_bucket" in scan


def test_a_full_filter_and_replays_stay_exact(spark, tmp_path):
    """With one block nearly every key is possible; a replayed batch, or one cut short after its rows, adds nothing."""
    table, known = pair(spark, tmp_path, blocks=1)
    many = spark.range(60000).selectExpr("id AS k", "'x' AS part", "'a' AS v")
    known.add(many, 0)
    insert_absent(table, known, frame(spark, range(40), "a"), 1)
    for number in (2, 2, 3):
        insert_absent(table, known, frame(spark, range(30, 60), "b"), number)
    rows = sorted((r.k, r.v) for r in table.read().collect())
    assert rows == [(i, "a" if i < 40 else "b") for i in range(60)]
    assert known.possible(frame(spark, range(60), "z")).count() == 60


def test_null_keys_fail_and_empty_batches_add_nothing(spark, tmp_path):
    table, known = pair(spark, tmp_path)
    with pytest.raises(Exception, match="is null"):
        insert_absent(table, known, frame(spark, [1], "a").withColumn("part", F.lit(None).cast("string")), 0)
    insert_absent(table, known, frame(spark, [1], "a"), 1)
    insert_absent(table, known, frame(spark, [], "a"), 2)
    assert table.read().count() == 1
