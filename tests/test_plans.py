"""Physical plans: what must reach the scan, and what must never appear."""

import re

import pytest

from tidemill.operators import changes
from tidemill.plans import REGISTRY
from tidemill.sources import catalog

FOLDER = "/root/testdata/sf0.001"
QUERIES = dict(REGISTRY)
# Jobs that run while the query is built: their plans are those of the stored results.
BATCH = [n for n in sorted(QUERIES) if n.split("_")[0] not in ("src", "snk", "stm", "set", "dml", "str")]


def plan(spark, name):
    return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python_rows(spark, name):
    text = plan(spark, name)
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert unwanted not in text


@pytest.mark.parametrize("name, pushed", [
    ("flt_01_equality", "EqualTo(c_mktsegment,AUTOMOBILE)"),
    ("flt_02_threshold", "GreaterThan(value,7.5)"),
    ("flt_04_valid_rows", "GreaterThan(c_acctbal,0.0)"),
    ("dml_11_incremental_load", "GreaterThan(o_orderdate,"),
])
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()


@pytest.mark.parametrize("name, columns", [
    ("agg_13_key_figures", {"l_quantity", "l_extendedprice"}),
    ("agg_03_total", {"o_totalprice"}),
])
def test_only_needed_columns_are_read(spark, name, columns):
    (read,) = set(re.findall(r"FileScan parquet \[([^\]]*)\]", plan(spark, name)))
    assert {c.split("#")[0] for c in read.split(",")} == columns


@pytest.mark.parametrize("name, operator", [
    ("srt_02_top_profit", "TakeOrderedAndProject"),
    ("srt_06_top_groups", "WindowGroupLimit"),
    ("set_02_keep_first", "WindowGroupLimit"),
    ("dml_12_latest_version", "WindowGroupLimit"),
])
def test_limits_apply_before_the_shuffle(spark, name, operator):
    assert operator in plan(spark, name)


def test_cut_rows_go_through_one_window_per_section(spark, small_sections):
    text = plan(spark, "win_03_row_number")
    windows = [line for line in text.splitlines() if "Window [row_number()" in line]
    assert windows and all("windowspecdefinition(_section" in line for line in windows)


@pytest.fixture
def sorted_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_in_buckets_are_joined_where_they_lie(spark, tmp_path, sorted_joins):
    """No exchange over a stored side: one for the batch of an upsert, none for two tables in the same buckets."""
    catalog.recreate_database(spark, "tidemill_buckets", str(tmp_path / "db"))
    rows = spark.range(1000).selectExpr("id AS k", "id % 7 AS v")
    for name in ("one", "two"):
        catalog.save_bucketed(rows, f"tidemill_buckets.{name}", str(tmp_path / name), ["k"], 4)
        assert len(list((tmp_path / name).glob("*.parquet"))) == 4
    one, two = spark.table("tidemill_buckets.one"), spark.table("tidemill_buckets.two")
    both = one.join(two, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in both and "Exchange" not in both
    batch = spark.createDataFrame([(5, 1), (2000, 1)], "k LONG, v LONG")
    merged = changes.upsert(one, batch, ["k"], null_keys=False)
    text = merged._jdf.queryExecution().executedPlan().toString()
    anti = text.split("LeftAnti", 1)[1]
    assert anti.count("Exchange") == 1 and "Bucketed: true" in anti.split("Exchange")[0]
    catalog.save_bucketed(merged, "tidemill_buckets.three", str(tmp_path / "three"), ["k"], 4, spread=False)
    three = spark.table("tidemill_buckets.three")
    assert three.count() == 1001 and three.filter("k = 5").first().v == 1
    assert "Exchange" not in three.join(two, "k")._jdf.queryExecution().executedPlan().toString()
    nothing = spark.createDataFrame([(None, 1)], "k LONG, v LONG")
    with pytest.raises(Exception, match="is null"):
        changes.upsert(one, nothing, ["k"], null_keys=False).collect()


def test_buckets_grow_with_the_rows(spark, tmp_path, monkeypatch, sorted_joins):
    """A task joins one bucket, so more rows must come in more buckets of the same size."""
    monkeypatch.setattr(catalog, "BUCKET_ROWS", 50, raising=False)
    tables = {
        "lineitem": spark.range(1000).selectExpr("id % 600 AS l_orderkey", "id % 7 AS l_partkey", "id AS l_linenumber", "2D AS l_quantity"),
        "orders": spark.range(600).selectExpr(
            "id AS o_orderkey", "id % 9 AS o_custkey", "TIMESTAMP_NTZ '1998-06-01' + make_interval(0, 0, 0, id) AS o_orderdate", "1D AS o_totalprice"),
        "part": spark.range(7).selectExpr("id AS p_partkey", "3D AS p_retailprice"),
        "customer": spark.range(9).selectExpr("id AS c_custkey", "concat('c', id) AS c_name"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    fact = QUERIES["jn_02_bucketed_fact"](spark, str(tmp_path))
    assert fact._jdf.queryExecution().executedPlan().toString().count("20 out of 20") == 2
    assert fact.count() == 1000
    merged = QUERIES["dml_01_bucketed_upsert"](spark, str(tmp_path))
    assert "12 out of 12" in merged.groupBy("o_orderkey").count()._jdf.queryExecution().executedPlan().toString()
    assert merged.count() == 600
