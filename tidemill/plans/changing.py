"""Upserts, slowly changing dimensions, incremental loads and versioned tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import changes
from tidemill.plans.ingest import fresh_database
from tidemill.plans.registry import query
from tidemill.sources import catalog
from tidemill.sources.tables import FolderTable


def moment(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query("dml_01_fact_upsert", """
    SELECT o_orderkey, NULLIF(o_custkey, 7) AS o_custkey, year(o_orderdate) >= 1999 AS updated,
           CASE WHEN year(o_orderdate) >= 1999 THEN round(o_totalprice * 1.1, 4) ELSE o_totalprice END AS amount
    FROM orders WHERE year(o_orderdate) < 2000 OR year(o_orderdate) >= 1999""")
def fact_upsert(t):
    """Orders before 2000 are stored; those from 1999 arrive with a new amount.

    Customer 7 is unknown to the dimension, so its key is null on both sides.
    """
    keyed = t.orders.withColumn("o_custkey", F.nullif("o_custkey", F.lit(7)))
    pick = lambda df, updated, amount: df.select(
        "o_orderkey", "o_custkey", F.lit(updated).alias("updated"), amount.alias("amount")
    )
    target = pick(keyed.filter("o_orderdate < TIMESTAMP_NTZ '2000-01-01'"), False, F.col("o_totalprice"))
    source = pick(keyed.filter("o_orderdate >= TIMESTAMP_NTZ '1999-01-01'"), True, F.round(F.col("o_totalprice") * 1.1, 4))
    return changes.upsert(target, source, ["o_orderkey", "o_custkey"])


@query("dml_01_bucketed_upsert", """
    SELECT o_orderkey, o_orderdate >= TIMESTAMP '1999-01-01' AS updated,
           CASE WHEN o_orderdate >= TIMESTAMP '1999-01-01' THEN round(o_totalprice * 1.1, 4) ELSE o_totalprice END AS amount
    FROM orders""")
def bucketed_upsert(t):
    """Orders before 2000 lie in buckets of their key, where those from 1999 reach them; the result lies in buckets again."""
    stored, merged = f"{fresh_database(t, 'buckets')}.orders", f"{fresh_database(t, 'buckets')}.orders"
    pick = lambda df, updated, amount: df.select("o_orderkey", F.lit(updated).alias("updated"), amount.alias("amount"))
    before = pick(t.orders.filter("o_orderdate < TIMESTAMP_NTZ '2000-01-01'"), False, F.col("o_totalprice"))
    buckets = catalog.buckets_for(t.orders)
    catalog.save_bucketed(before, stored, t.scratch("orders"), ["o_orderkey"], buckets)
    source = pick(t.orders.filter("o_orderdate >= TIMESTAMP_NTZ '1999-01-01'"), True, F.round(F.col("o_totalprice") * 1.1, 4))
    rows = changes.upsert(t.spark.table(stored), source, ["o_orderkey"], null_keys=False)
    catalog.save_bucketed(rows, merged, t.scratch("orders"), ["o_orderkey"], buckets, spread=False)
    return t.spark.table(merged)


@query("dml_02_scd1", """
    WITH keyed AS (SELECT *, NULLIF(c_custkey, 7) AS k FROM customer),
    old AS (SELECT *, row_number() OVER (ORDER BY k NULLS FIRST) AS dim_key FROM keyed WHERE c_nationkey < 15 OR k IS NULL),
    fresh AS (SELECT *, row_number() OVER (ORDER BY k) + (SELECT max(dim_key) FROM old) AS dim_key
              FROM keyed WHERE c_nationkey >= 15 AND k IS NOT NULL)
    SELECT dim_key, k AS c_custkey,
           CASE WHEN c_nationkey >= 10 OR k IS NULL THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment,
           TIMESTAMP '2025-01-01' AS create_date,
           CASE WHEN c_nationkey >= 10 OR k IS NULL THEN TIMESTAMP '2025-02-01' ELSE TIMESTAMP '2025-01-01' END AS update_date
    FROM old
    UNION ALL SELECT dim_key, k, lower(c_mktsegment), TIMESTAMP '2025-02-01', TIMESTAMP '2025-02-01' FROM fresh""")
def scd1(t):
    """Nations below 15 load first; nations from 10 arrive later with a changed segment, each row twice.

    Customer 7 has a null key in both loads and stays one member.
    """
    members = t.customer.withColumn("c_custkey", F.nullif("c_custkey", F.lit(7)))
    first = members.filter("c_nationkey < 15 OR c_custkey IS NULL").select("c_custkey", "c_mktsegment")
    table = FolderTable(t.spark, t.scratch("dimension"))
    table.write(changes.scd1(None, first, "c_custkey", "dim_key", moment("2025-01-01 00:00:00")))
    feed = members.filter("c_nationkey >= 10 OR c_custkey IS NULL").select(
        "c_custkey", F.lower("c_mktsegment").alias("c_mktsegment")
    )
    return changes.scd1(table.read(), feed.unionByName(feed), "c_custkey", "dim_key", moment("2025-02-01 00:00:00"))


@query("dml_03_scd2", """
    WITH marked AS (SELECT user_id, event_type, ts, event_id, lag(event_type) OVER w AS before FROM events
                    WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    versions AS (SELECT * FROM marked WHERE before IS DISTINCT FROM event_type)
    SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER w AS valid_to, lead(ts) OVER w IS NULL AS is_current
    FROM versions WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def scd2(t):
    return changes.scd2(t.events, ["user_id"], ["ts", "event_id"], ["event_type"])


@query("dml_03_scd2_batches", """
    WITH log AS (SELECT DISTINCT ON (user_id, ts) user_id, ts, event_type FROM events ORDER BY user_id, ts, event_id),
    marked AS (SELECT *, lag(event_type) OVER w AS before FROM log WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    versions AS (SELECT * FROM marked WHERE before IS DISTINCT FROM event_type)
    SELECT user_id, event_type, ts AS valid_from, lead(ts) OVER w AS valid_to, lead(ts) OVER w IS NULL AS is_current
    FROM versions WINDOW w AS (PARTITION BY user_id ORDER BY ts)""")
def scd2_batches(t):
    """The history stored batch by batch, the later events first, the last batch sent twice."""
    log = t.events.groupBy("user_id", "ts").agg(F.min_by("event_type", "event_id").alias("event_type"))
    table = FolderTable(t.spark, t.scratch("history"))
    late = "ts < TIMESTAMP_NTZ '2024-01-10'"
    for batch in (f"NOT ({late})", late, late):
        stored = table.read() if table.versions() else None
        table.write(changes.scd2_step(stored, log.filter(batch), ["user_id"], "ts", ["event_type"]))
    return changes.scd2_versions(table.read())


@query("dml_04_upsert_latest", """
    SELECT user_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts >= TIMESTAMP '2024-01-20' DESC,
            ts DESC, event_id DESC) AS place FROM events) WHERE place = 1""")
def upsert_latest(t):
    """Two batches of repeated ids; the last row of the later batch wins."""
    newest = [F.desc("ts"), F.desc("event_id")]
    old = t.events.filter("ts < TIMESTAMP_NTZ '2024-01-20'")
    new = t.events.filter("ts >= TIMESTAMP_NTZ '2024-01-20'")
    table = changes.upsert_latest(None, old, ["user_id"], *newest)
    return changes.upsert_latest(table, new, ["user_id"], *newest).select("user_id", "event_type", "value")


@query("dml_05_insert_absent", """
    WITH stored AS (SELECT url AS link, 'stored' AS origin, min(page_id) AS page_id FROM pages
                    WHERE contains(url, 'page=') GROUP BY url)
    SELECT * FROM stored
    UNION ALL SELECT url, 'feed', min(page_id) FROM pages WHERE url NOT IN (SELECT link FROM stored) GROUP BY url""")
def insert_absent(t):
    pages = t.pages.select(F.col("url").alias("link"), F.lit("feed").alias("origin"), "page_id")
    stored = pages.filter(F.contains("link", F.lit("page="))).groupBy("link").agg(
        F.lit("stored").alias("origin"), F.min("page_id").alias("page_id")
    )
    return changes.insert_absent(stored, pages, ["link"], F.col("page_id"))


@query("dml_06_update", """
    SELECT c_custkey, CASE WHEN c_nationkey = 1 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def update(t):
    rows = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    return changes.update_where(rows, F.col("c_nationkey") == 1, c_mktsegment=F.lit("MOVED")).drop("c_nationkey")


@query("dml_07_delete", "SELECT * FROM customer WHERE NOT (c_nationkey = 1)")
def delete(t):
    return changes.delete_where(t.customer, F.col("c_nationkey") == 1)


@query("dml_08_restore", "SELECT * FROM customer")
def restore(t):
    """An earlier version of a stored table becomes the current one again."""
    table = FolderTable(t.spark, t.scratch("restore"))
    first = table.write(t.customer)
    table.write(changes.delete_where(table.read(), F.col("c_nationkey") == 1))
    table.write(table.read(first))
    return table.read()


@query("dml_09_history", """
    SELECT 0 AS version, count(*) AS rows FROM supplier
    UNION ALL SELECT 1, count(*) FROM supplier WHERE s_acctbal >= 0
    UNION ALL SELECT 2, count(*) FROM supplier""")
def history(t):
    table = FolderTable(t.spark, t.scratch("history"))
    table.write(t.supplier)
    table.write(changes.delete_where(table.read(), F.col("s_acctbal") < 0))
    table.write(table.read(0))
    return table.sizes()


@query("dml_10_compact", "SELECT s_suppkey, s_name, CAST(2 AS BIGINT) AS files FROM supplier")
def compact(t):
    """Many small files rewritten as two."""
    table = FolderTable(t.spark, t.scratch("compact"))
    table.write(t.supplier.repartition(8))
    table.write(table.read().repartition(2))
    stored = table.read().select("s_suppkey", "s_name", F.input_file_name().alias("file"))
    files = stored.agg(F.count_distinct("file")).scalar().cast("bigint")
    return stored.select("s_suppkey", "s_name", files.alias("files"))


@query("dml_11_incremental_load", """
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01')""")
def incremental_load(t):
    orders = t.orders.select("o_orderkey", "o_orderdate")
    stored = orders.filter("o_orderdate < TIMESTAMP_NTZ '1999-01-01'")
    return changes.newer_than_stored(orders, stored, "o_orderdate")


@query("dml_12_latest_version", """
    SELECT user_id, event_id, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS place FROM events)
    WHERE place = 1""")
def latest_version(t):
    log = t.events.select("user_id", "event_id", "event_type", "ts")
    return changes.latest(log, ["user_id"], F.desc("ts"), F.desc("event_id")).drop("ts")


BATCHES_SQL = """
    WITH log AS (
        SELECT c_custkey AS id, c_mktsegment AS segment, 0 AS batch FROM customer WHERE c_nationkey < 20
        UNION ALL SELECT c_custkey, c_mktsegment, 1 FROM customer WHERE c_nationkey >= 20
        UNION ALL SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN 'CHANGED' ELSE c_mktsegment END, 2
            FROM customer WHERE c_nationkey < 3)"""


def batches(t):
    pick = lambda condition, segment: t.customer.filter(condition).select(
        F.col("c_custkey").alias("id"), segment.alias("segment")
    )
    changed = F.when(F.col("c_acctbal") > 5000, "CHANGED").otherwise(F.col("c_mktsegment"))
    return [
        pick("c_nationkey < 20", F.col("c_mktsegment")),
        pick("c_nationkey >= 20", F.col("c_mktsegment")),
        pick("c_nationkey < 3", changed),
    ]


@query("dml_13_fold_batches", BATCHES_SQL + """
    SELECT id, segment FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY batch DESC) AS place FROM log)
    WHERE place = 1""")
def fold_batches(t):
    return changes.fold_batches(batches(t), ["id"])


@query("dml_13_fold_history", BATCHES_SQL + """,
    versions AS (SELECT * FROM (SELECT *, lag(segment) OVER (PARTITION BY id ORDER BY batch) AS before FROM log)
                 WHERE before IS DISTINCT FROM segment)
    SELECT id, segment, batch AS valid_from, lead(batch) OVER w AS valid_to, lead(batch) OVER w IS NULL AS is_current
    FROM versions WINDOW w AS (PARTITION BY id ORDER BY batch)""")
def fold_history(t):
    return changes.fold_history(batches(t), ["id"])
