"""Rules, quarantine and reports."""

import pytest
from pyspark.sql import functions as F

from tidemill.operators import quality
from tidemill.schemas import STORE, STORE_KEYS, STORE_RULES


def test_store_rules_report_restarted_ids(spark):
    """Item ids restart every hour: unique only together with the order."""
    at = "2024-10-31 14:00:00"
    rows = [(501, 1, 9, 2, at), (502, 1, 9, 1, at), (501, 2, 9, 1, at), (None, 2, 9, 1, at)]
    items = spark.createDataFrame(rows, "id INT, order_id INT, goods_id INT, qty INT, at STRING").selectExpr(
        "id", "order_id", "goods_id", "qty", "CAST(at AS TIMESTAMP) created_at", "CAST(at AS TIMESTAMP) updated_at")
    names = [f.split()[0] for f in STORE["order_item"].split(", ")]
    report = quality.check_table(items, "order_item", names, [["id"], STORE_KEYS["order_item"]]).collect()
    found = {(r.column_name, r.rule): r.failures for r in report}
    assert len(report) == 8
    assert found["id", "not_null"] == 1 and found["id", "unique"] == 1
    assert found["order_id,id", "unique"] == 0 and found["qty", "not_null"] == 0


def test_unknown_rule_outcome_fails(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "product_id INT, product_name STRING")
    rules = {"rule1": "product_id IS NOT NULL", "rule2": "length(product_name) > 0"}
    assert quality.keep_expected(rows, rules).count() == 1
    assert {r.rule: r.failures for r in quality.rule_failures(rows, rules).collect()} == {"rule1": 1, "rule2": 1}


def test_quarantine_conserves_rows(spark):
    rows = spark.range(100).withColumn("v", F.when(F.col("id") % 7 != 0, F.col("id") - 50))
    checks = [(F.col("v").isNull(), "HTTP 404"), (F.col("v") < 0, "ExtractFailed")]
    good, bad = quality.quarantine(rows, "id", checks)
    tally = {r.error: r.n for r in quality.error_tally(bad).collect()}
    assert good.count() + tally["total"] == 100 and tally["HTTP 404"] == 15
    report = quality.run_report(quality.with_error(rows, checks)).first()
    assert report.total_ids == 100 == report.succeeded + report.failed and report.reasons == 2


def test_run_report_golden(spark):
    ids = spark.range(200000).withColumn("error", F.when(F.col("id") < 1058, "HTTP 404"))
    report = quality.run_report(ids).first()
    assert (report.total_ids, report.succeeded, report.failed) == (200000, 198942, 1058)


def test_primary_key(spark):
    good = spark.createDataFrame([(1,), (2,)], "id INT")
    assert quality.require_primary_key(good, ["id"]).count() == 2
    for rows in ([(1,), (1,)], [(1,), (None,)]):
        with pytest.raises(ValueError):
            quality.require_primary_key(spark.createDataFrame(rows, "id INT"), ["id"])


def test_retry_set(spark):
    ids = spark.createDataFrame([("1",), ("2",), ("3",)], "id STRING")
    loaded = spark.createDataFrame([("1",), ("1",)], "id STRING")
    errors = spark.createDataFrame([("2", "HTTP 404", 1), ("2", "Timeout", 2), ("1", "HTTP 500", 1)], "id STRING, error STRING, n INT")
    assert sorted(map(tuple, quality.retry_set(ids, loaded, errors, "n").collect())) == [("2", "Timeout"), ("3", None)]
    assert quality.reconcile(ids, loaded).first().missing == 1


def test_retry_rows_have_the_loaded_shape(spark):
    loaded = spark.createDataFrame([(1, "n", [1])], "id BIGINT, name STRING, images ARRAY<INT>")
    rows = quality.retry_rows(spark.createDataFrame([("7", "HTTP 404")], "id STRING, error STRING"), loaded)
    assert rows.schema == loaded.schema and [tuple(r) for r in rows.collect()] == [(7, None, None)]


def test_store_rules_are_complete():
    assert sum(len(filled) for filled, _ in STORE_RULES.values()) == 27 and len(STORE_RULES) == 5
