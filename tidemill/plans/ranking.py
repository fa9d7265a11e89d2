"""Ranks, dense keys, batches, sorted positions and running device state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions import values
from tidemill.operators import ordered
from tidemill.plans.registry import query


def yearly(t) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))


def ranking_sql(function: str, name: str, tie: str = "") -> str:
    return f"""
    SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
           {function}() OVER (PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC{tie}) AS {name}
    FROM orders"""


@query("win_01_dense_rank", ranking_sql("dense_rank", "flag"))
def dense_rank(t):
    return ordered.ranked(yearly(t), ["year"], "o_totalprice", descending=True, dense_rank="flag")


@query("win_02_rank", ranking_sql("rank", "rank_flag"))
def rank(t):
    return ordered.ranked(yearly(t), ["year"], "o_totalprice", descending=True, rank="rank_flag")


@query("win_03_row_number", ranking_sql("row_number", "row_flag", ", o_orderkey"))
def row_number(t):
    return ordered.ranked(
        yearly(t), ["year"], "o_totalprice", tie="o_orderkey", descending=True, row_number="row_flag"
    )


def with_dense_rank(df: DataFrame) -> DataFrame:
    return ordered.ranked(df, ["year"], "total_amount", descending=True, dense_rank="flag")


@query("udf_03_reusable_method", """
    SELECT o_orderkey, total_amount, CAST(year AS INTEGER) AS year,
           dense_rank() OVER (PARTITION BY year ORDER BY total_amount DESC) AS flag
    FROM (SELECT o_orderkey, round(o_totalprice / 10000) * 10000 AS total_amount, year(o_orderdate) AS year FROM orders)""")
def reusable_method(t):
    """Amounts rounded to ten thousands, so most ranks are shared."""
    rounded = (F.round(F.col("o_totalprice") / 10000) * 10000).alias("total_amount")
    orders = t.orders.select("o_orderkey", rounded, F.year("o_orderdate").alias("year"))
    return orders.transform(with_dense_rank)


@query("win_04_dense_keys", """
    SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS dim_key FROM customer""")
def dense_keys(t):
    return ordered.dense_keys(t.customer.select("c_custkey", "c_name"), "c_custkey", "dim_key")


@query("win_04_dense_keys_from_text", """
    SELECT c_name, row_number() OVER (ORDER BY c_name) + (SELECT max(s_suppkey) FROM supplier) AS dim_key
    FROM customer""")
def dense_keys_from_text(t):
    last = t.supplier.select(F.max("s_suppkey")).scalar()
    return ordered.dense_keys(t.customer.select("c_name"), "c_name", "dim_key", after=last)


@query("win_05_batch_numbers", """
    SELECT o_orderkey, CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 1000) + 1 AS BIGINT) AS batch
    FROM orders""")
def batch_numbers(t):
    return ordered.batch_numbers(t.orders.select("o_orderkey"), "o_orderkey", 1000, "batch")


def pulses(t) -> DataFrame:
    delta = F.when(F.col("event_type") == "click", 5).when(F.col("event_type") == "error", -5).otherwise(0)
    events = t.events.select("event_id", "user_id", "ts", delta.alias("delta"))
    return ordered.speed_trace(events, ["user_id"], ["ts", "event_id"], F.col("delta"))


SPEED_SQL = """
    WITH pulses AS (
        SELECT event_id, user_id, ts, sum(CASE event_type WHEN 'click' THEN 5 WHEN 'error' THEN -5 ELSE 0 END)
            OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM events),
    speeds AS (
        SELECT event_id, user_id, ts, CAST(s - least(0, min(s)
            OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)) AS BIGINT) AS speed
        FROM pulses)"""


@query("win_06_floored_speed", SPEED_SQL + " SELECT event_id, user_id, speed FROM speeds")
def floored_speed(t):
    return pulses(t).select("event_id", "user_id", "speed")


@query("win_07_odometer", SPEED_SQL + """
    SELECT event_id, CAST(sum(speed) OVER w AS BIGINT) AS odometer, row_number() OVER w AS step,
           round(avg(speed) OVER w, 6) AS average_speed
    FROM speeds WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def odometer(t):
    trace = pulses(t).withColumn("average_speed", F.round("average_speed", 6))
    return trace.select("event_id", "odometer", "step", "average_speed")


@query("srt_01_sorted_by_date", """
    SELECT o_orderkey, released, row_number() OVER (ORDER BY released DESC NULLS LAST, o_orderkey) AS place
    FROM (SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END AS released FROM orders)""")
def sorted_by_date(t):
    """Newest first, unreadable dates last, with the place of every row."""
    written = F.when(F.col("o_orderpriority") == "1-URGENT", "unknown").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")
    )
    dated = t.orders.select("o_orderkey", values.to_moment(written, "yyyy-MM-dd").cast("timestamp_ntz").alias("released"))
    placed = ordered.ranked(dated, [], "released", tie="o_orderkey", descending=True, row_number="place")
    return placed.orderBy(F.desc_nulls_last("released"), "o_orderkey")
