"""Star joins, key lookups, feed correlation, unions and duplicate removal."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import semi
from tidemill.operators import joins, sets
from tidemill.plans.ingest import fresh_database
from tidemill.plans.registry import query
from tidemill.sources import catalog, readers, writers
from tidemill.sources.tables import BucketTable, KeyFilter, insert_absent


def transactions(t):
    """One row per line item with its buyer, value and order date."""
    items = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("goods_id"),
        F.col("l_linenumber").alias("order_item_id"), F.col("l_quantity").alias("quantity"),
    )
    goods = t.part.select(F.col("p_partkey").alias("goods_id"), F.col("p_retailprice").alias("price"))
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("order_date"),
    )
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"))
    return joins.star_fact(items, goods, orders, users).select(
        "user_id", "user_name", "order_item_id", "number_of_items_ordered", "total_purchase_value",
        "order_date",
    )


def trips(t):
    """Line items as trips from the supplier's nation to the customer's.

    Tables join one by one, so Spark knows the size of every right side from its files.
    """
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    zone = lambda side: nation.select(
        F.col("n_nationkey").alias(f"{side}_key"), F.col("n_name").alias(f"{side}_zone"),
        F.col("r_name").alias(f"{side}_borough"),
    )
    return (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(zone("pickup"), F.col("s_nationkey") == F.col("pickup_key"))
        .join(zone("dropoff"), F.col("c_nationkey") == F.col("dropoff_key"))
        .select(
            "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("vendor"),
            F.col("o_orderstatus").alias("trip_type"), "pickup_zone", "pickup_borough",
            "dropoff_zone", "dropoff_borough", F.col("l_quantity").alias("distance"),
            F.col("l_extendedprice").alias("fare"),
        )
    )


TRIPS_SQL = """
    trips AS (
        SELECT l_orderkey, l_linenumber, l_suppkey AS vendor, o_orderstatus AS trip_type,
               pn.n_name AS pickup_zone, pr.r_name AS pickup_borough, dn.n_name AS dropoff_zone,
               dr.r_name AS dropoff_borough, l_quantity AS distance, l_extendedprice AS fare
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation pn ON s_nationkey = pn.n_nationkey JOIN region pr ON pn.n_regionkey = pr.r_regionkey
        JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
        JOIN nation dn ON c_nationkey = dn.n_nationkey JOIN region dr ON dn.n_regionkey = dr.r_regionkey)"""


@query("jn_01_left_join", """
    SELECT d.doc_id, lang, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def left_join(t):
    labels = t.labels.withColumnRenamed("doc_id", "labelled")
    return joins.left_join_many(t.documents.select("doc_id", "lang"), labels, "doc_id", "labelled").drop("labelled")


@query("jn_02_star_fact", """
    SELECT o_custkey AS user_id, c_name AS user_name, l_linenumber AS order_item_id,
           l_quantity AS number_of_items_ordered, l_quantity * p_retailprice AS total_purchase_value,
           o_orderdate AS order_date
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey""")
def star_fact(t):
    return transactions(t)


@query("jn_02_bucketed_fact", """
    SELECT o_custkey AS user_id, c_name AS user_name, l_linenumber AS order_item_id,
           l_quantity AS number_of_items_ordered, l_quantity * p_retailprice AS total_purchase_value,
           o_orderdate AS order_date
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey""")
def bucketed_fact(t):
    """The fact of items and orders that lie in buckets of the order's key, as many as the items fill."""
    database = fresh_database(t, "buckets")
    items = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("goods_id"),
        F.col("l_linenumber").alias("order_item_id"), F.col("l_quantity").alias("quantity"),
    )
    orders = t.orders.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("order_date")
    )
    buckets = catalog.buckets_for(items, orders)
    for name, rows in (("items", items), ("orders", orders)):
        catalog.save_bucketed(rows, f"{database}.{name}", t.scratch(name), ["order_id"], buckets)
    goods = t.part.select(F.col("p_partkey").alias("goods_id"), F.col("p_retailprice").alias("price"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name"))
    fact = joins.star_fact(t.spark.table(f"{database}.items"), goods, t.spark.table(f"{database}.orders"), users)
    return fact.select("user_id", "user_name", "order_item_id", "number_of_items_ordered", "total_purchase_value", "order_date")


@query("jn_03_key_lookup", """
    SELECT d.doc_id, d.source, l.quality AS dim_quality, p.url AS dim_url
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN pages p ON d.doc_id = p.page_id""")
def key_lookup(t):
    fact = t.documents.select("doc_id", "source")
    fact = joins.lookup(fact, t.labels, "doc_id", "doc_id", dim_quality="quality")
    return joins.lookup(fact, t.pages, "doc_id", "page_id", dim_url="url")


@query("jn_04_new_rows", """
    SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def new_rows(t):
    return joins.new_rows(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"])


@query("jn_04_key_filter", """
    SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'label' ELSE 'document' END AS came_from
    FROM documents UNION SELECT doc_id, 'label' FROM labels""")
def key_filter(t):
    """Labelled ids are stored; of the documents only those with new ids are added, found by a stored filter."""
    table = BucketTable(t.spark, t.scratch("rows"), ["doc_id"], 8)
    known = KeyFilter(t.spark, t.scratch("filter"), ["doc_id"], blocks=64, folders=8)
    for number, (rows, name) in enumerate(((t.labels, "label"), (t.documents, "document"))):
        insert_absent(table, known, rows.select("doc_id", F.lit(name).alias("came_from")), number)
    return table.read()


@query("jn_05_existing_rows", """
    SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""")
def existing_rows(t):
    return joins.existing_rows(t.documents.select("doc_id", "lang"), t.labels, ["doc_id"])


@query("jn_06_role_playing", f"WITH {TRIPS_SQL} SELECT * FROM trips")
def role_playing(t):
    return trips(t)


def hourly(events, kind: str, name: str):
    """One reading per device and hour of one feed."""
    return (
        events.filter(F.col("event_type") == kind)
        .groupBy("user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"))
        .agg(F.round(F.avg("value"), 6).alias(name))
    )


@query("jn_07_feed_correlation", """
    SELECT c.user_id, c.hour, click, view FROM
        (SELECT user_id, date_trunc('hour', ts) AS hour, round(avg(value), 6) AS click FROM events
         WHERE event_type = 'click' GROUP BY 1, 2) c
    JOIN (SELECT user_id, date_trunc('hour', ts) AS hour, round(avg(value), 6) AS view FROM events
         WHERE event_type = 'view' GROUP BY 1, 2) v ON c.user_id = v.user_id AND c.hour = v.hour""")
def feed_correlation(t):
    events = t.events
    return joins.correlate(hourly(events, "click", "click"), hourly(events, "view", "view"), "user_id", "hour")


KINDS = ["click", "error", "purchase", "signup", "view"]


@query("jn_07_five_feeds", "SELECT * FROM " + " JOIN ".join(
    f"""(SELECT user_id, date_trunc('day', ts) AS day, round(avg(value), 6) AS {kind}_value FROM events
         WHERE event_type = '{kind}' GROUP BY 1, 2) {kind}""" + (" USING (user_id, day)" if i else "") for i, kind in enumerate(KINDS)))
def five_feeds(t):
    """The daily readings of five feeds, one row where all of them have one."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    daily = lambda kind: t.events.filter(F.col("event_type") == kind).groupBy("user_id", day).agg(F.round(F.avg("value"), 6).alias("value"))
    return joins.correlate_all({kind: daily(kind) for kind in KINDS}, "user_id", "day")


@query("jn_08_ragged_zip", """
    SELECT p_partkey, CAST(pos AS INTEGER) AS pos, coalesce(names[pos + 1], 'N/A') AS word,
           coalesce(types[pos + 1], 'N/A') AS type
    FROM (SELECT p_partkey, names, types, unnest(range(greatest(len(names), len(types)))) AS pos
          FROM (SELECT p_partkey, string_split(p_name, ' ') AS names, string_split(p_type, ' ') AS types FROM part))""")
def ragged_zip(t):
    pairs = semi.zip_lists(F.split("p_name", " "), F.split("p_type", " "), names=["word", "type"])
    return t.part.select("p_partkey", F.posexplode(pairs).alias("pos", "pair")).select(
        "p_partkey", "pos", "pair.*"
    )


@query("set_01_union_by_name", """
    SELECT c_name AS name, c_custkey AS id, 'customer' AS kind FROM customer
    UNION ALL SELECT s_name, s_suppkey, 'supplier' FROM supplier""")
def union_by_name(t):
    customers = t.customer.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"))
    suppliers = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return customers.unionByName(suppliers)


FIRST_LINE = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query("set_02_keep_first", f"""
    SELECT l_orderkey, l_linenumber, {", ".join(FIRST_LINE)} FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY {", ".join(FIRST_LINE)}) AS place FROM lineitem) WHERE place = 1""")
def keep_first(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", *FIRST_LINE)
    return sets.keep_first(lines, ["l_orderkey", "l_linenumber"], *[F.col(c) for c in FIRST_LINE])


@query("set_03_first_seen", """
    SELECT props, min(event_id) AS position FROM events GROUP BY props""")
def first_seen(t):
    return sets.first_seen(t.events.withColumnRenamed("event_id", "position"), "props", "position")


@query("set_04_merge_error_files", """
    SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_nationkey = 7""")
def merge_error_files(t):
    folder = t.scratch("errors")
    for label, bad in (("balance", "c_acctbal < 0"), ("nation", "c_nationkey = 7")):
        errors = t.customer.filter(bad).select(F.col("c_custkey").cast("string").alias("id"), F.lit(label).alias("error"))
        writers.write_json_lines(errors, f"{folder}/errors_{label}")
    return readers.read_failed_ids(t.spark, f"{folder}/errors_*")
