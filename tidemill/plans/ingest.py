"""Sources and sinks, exercised by writing the given tables in a format and reading them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemill.plans.registry import query
from tidemill.sources.tables import FolderTable
from tidemill.sources import catalog, readers, splitting, writers
from tidemill.streaming import feeds

CUSTOMER = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
SUPPLIER = "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
ORDERS = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)
MICROSECONDS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
READING = "event_id BIGINT, deviceId STRING, timestamp TIMESTAMP, speed DOUBLE, topic STRING"


def fresh_database(t, label: str) -> str:
    name = f"tidemill_{label}_{uuid.uuid4().hex[:12]}"
    catalog.recreate_database(t.spark, name, t.scratch(name))
    return name


def readings(events):
    """Events as messages of a device feed."""
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("deviceId"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("speed"),
        F.col("event_type").alias("topic"),
    )


def as_messages(df):
    return df.select(F.to_json(F.struct(*df.columns), MICROSECONDS).alias("value"))


@query("src_01_csv_inferred", "SELECT * FROM customer")
def csv_inferred(t):
    path = t.scratch("csv")
    writers.write_csv(t.customer, path)
    return readers.read_csv(t.spark, path).withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("src_02_parquet_scan", "SELECT * FROM orders")
def parquet_scan(t):
    return readers.read_parquet(t.spark, t.path("orders"))


@query("src_03_explicit_schema_recursive", "SELECT event_id, user_id, value FROM events")
def explicit_schema_recursive(t):
    path = t.scratch("nested")
    t.events.write.partitionBy("event_type").parquet(path)
    return readers.read_parquet(
        t.spark, path, "event_id BIGINT, user_id BIGINT, value DOUBLE", recursive=True
    )


@query("src_04_catalog_table", """
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def catalog_table(t):
    table = f"{fresh_database(t, 'scan')}.supplier"
    catalog.save_external(t.supplier, table, t.scratch("supplier"))
    return t.spark.sql(f"SELECT * FROM {table}")


@query("src_05_versioned_scan", """
    SELECT 'region' AS table_name, count(*) AS n FROM region
    UNION ALL SELECT 'nation', count(*) FROM nation
    UNION ALL SELECT 'supplier', count(*) FROM supplier""")
def versioned_scan(t):
    counts = None
    for name in ("region", "nation", "supplier"):
        table = FolderTable(t.spark, t.scratch(name))
        table.write(getattr(t, name))
        one = table.read().agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query("src_06_file_arrival", """
    SELECT 'events' AS table_name, count(*) AS n, round(sum(value), 2) AS total FROM events
    UNION ALL SELECT 'orders', count(*), round(sum(o_totalprice), 2) FROM orders
    UNION ALL SELECT 'customer', count(*), round(sum(c_acctbal), 2) FROM customer""")
def file_arrival(t):
    landing = t.scratch("landing")
    measures = {"events": "value", "orders": "o_totalprice", "customer": "c_acctbal"}
    feeds.ingest_files(t.spark, measures, t.arrivals, landing)
    counts = None
    for name, measure in measures.items():
        one = t.spark.read.parquet(f"{landing}/data/{name}").agg(
            F.lit(name).alias("table_name"), F.count("*").alias("n"),
            F.round(F.sum(measure), 2).alias("total"),
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


@query("src_06_rescued_fields", """
    SELECT event_id, value, CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN event_type END AS event_type,
           CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN user_id END AS user_id,
           ts >= TIMESTAMP '2024-01-16' AS rescued FROM events""")
def rescued_fields(t):
    """The second half of the month arrives with two fields more; one run later the schema is widened by them."""
    arriving, landing = t.scratch("arriving"), feeds.Landing(t.spark, t.scratch("landing"))
    t.events.filter("ts < TIMESTAMP_NTZ '2024-01-16'").select("event_id", "value").write.parquet(arriving)
    landing.land(arriving)
    later = t.events.filter("ts >= TIMESTAMP_NTZ '2024-01-16'").select("event_id", "value", "event_type", "user_id")
    later.write.mode("append").parquet(arriving)
    landing.land(arriving)
    landing.widen("event_type STRING, user_id BIGINT")
    rows = landing.read()
    return rows.select("event_id", "value", "event_type", "user_id", F.col(landing.RESCUED).isNotNull().alias("rescued"))


READINGS_SQL = """
    SELECT event_id, CAST(user_id AS VARCHAR) AS "deviceId", ts AS "timestamp", value AS speed,
           event_type AS topic FROM events"""


@query("src_07_topic_stream", READINGS_SQL)
def topic_stream(t):
    topic, out = t.scratch("topic"), t.scratch("decoded")
    as_messages(readings(t.events)).write.text(topic)
    stream = feeds.read_topic(t.spark, "text", {"path": topic}, READING)
    feeds.await_all([feeds.write_feed(stream, f"{out}/data", f"{out}/checkpoint", drain=True)])
    decoded = t.spark.read.schema(READING).parquet(f"{out}/data")
    return decoded.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("src_07_redelivered", READINGS_SQL)
def redelivered(t):
    """A topic that delivers its first half twice, the second time after a restart."""
    topic, out = t.scratch("topic"), t.scratch("once")
    halves = [t.events.filter(f"ts {sign} TIMESTAMP_NTZ '2024-01-16'") for sign in ("<", ">=")]
    for part in (halves[0], halves[0].unionByName(halves[1])):
        as_messages(readings(part)).write.mode("append").text(topic)
        stream = feeds.read_topic(t.spark, "text", {"path": topic}, READING)
        feeds.await_all([feeds.write_feed(feeds.once(stream, "event_id"), f"{out}/data", f"{out}/checkpoint", drain=True)])
    decoded = t.spark.read.schema(READING).parquet(f"{out}/data")
    return decoded.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("src_08_stream_table", "SELECT event_id, user_id, event_type, value FROM events")
def stream_table(t):
    table = f"{fresh_database(t, 'stream')}.events"
    catalog.rebuild_model(t.events.select("event_id", "user_id", "event_type", "value"), table)
    out = t.scratch("streamed")
    stream = t.spark.readStream.table(table)
    feeds.await_all([feeds.write_feed(stream, f"{out}/data", f"{out}/checkpoint", drain=True)])
    return t.spark.read.schema(stream.schema).parquet(f"{out}/data")


@query("src_09_json_lines_and_arrays", """
    SELECT c_custkey AS id, c_name AS name FROM customer
    UNION ALL SELECT n_nationkey, n_name FROM nation""")
def json_lines_and_arrays(t):
    lines, arrays = t.scratch("lines"), t.scratch("arrays")
    t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).write.json(lines)
    record = F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    # A region lists a handful of nations, so one array per region stays small.
    per_region = t.nation.groupBy("n_regionkey").agg(F.to_json(F.collect_list(record)).alias("value"))
    per_region.write.partitionBy("n_regionkey").text(arrays)
    return readers.read_records(t.spark, "id BIGINT, name STRING", lines, f"{arrays}/*")


@query("src_09_large_arrays", """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer""")
def large_arrays(t):
    """Files of one array of up to 5,000 records each, every file read by as many tasks as it has splits."""
    arrays = t.scratch("arrays")
    record = F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    groups = t.customer.groupBy(F.floor(F.col("c_custkey") / 5000).alias("part")).agg(F.to_json(F.collect_list(record)).alias("value"))
    groups.write.partitionBy("part").text(arrays)
    return splitting.read_json_array(t.spark, f"{arrays}/*", "id BIGINT, name STRING, balance DOUBLE")


@query("src_10_xml_items", """
    SELECT url AS link, 'Page ' || page_id AS title, CAST(length(html) AS VARCHAR) AS description
    FROM pages""")
def xml_items(t):
    path = t.scratch("rss")
    items = t.pages.select(
        F.col("url").alias("link"),
        F.concat(F.lit("Page "), "page_id").alias("title"),
        F.length("html").cast("string").alias("description"),
    )
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    return readers.read_feed_items(t.spark, path).select("link", "title", "description")


@query("src_11_delta_tree", """
    SELECT o_orderkey, o_custkey, o_totalprice, 'orders' AS table_name,
           strftime(o_orderdate, '%Y') || '0101' AS batch_date,
           CASE WHEN o_orderstatus = 'F' THEN '00' ELSE '01' END AS batch_hour
    FROM orders""")
def delta_tree(t):
    root = t.scratch("tree")
    hour = F.when(F.col("o_orderstatus") == "F", "00").otherwise("01")
    rows = t.orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", hour.alias("hour"),
        F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("0101")).alias("date"), F.lit("orders.csv").alias("table"),
    )
    rows.write.partitionBy("date", "hour", "table").option("header", True).csv(root)
    return readers.read_delta_tree(
        t.spark, root, "orders", "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE"
    )


@query("src_12_typed_csv_load", "SELECT * FROM supplier")
def typed_csv_load(t):
    path, table = t.scratch("csv"), f"{fresh_database(t, 'load')}.supplier"
    writers.write_csv(t.supplier, path)
    catalog.load_csv_table(t.spark, table, SUPPLIER, path)
    return t.spark.table(table)


@query("src_13_quoted_csv", """
    SELECT doc_id, lang, length(text) AS chars, md5(text) AS text_md5 FROM documents""")
def quoted_csv(t):
    path = t.scratch("csv")
    writers.write_quoted_csv(t.documents.select("doc_id", "lang", "text"), path)
    back = readers.read_csv(t.spark, path, "doc_id BIGINT, lang STRING, text STRING", multiline=True)
    return back.select(
        "doc_id", "lang", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("text_md5")
    )


@query("src_13_large_quoted_csv", """
    SELECT doc_id, lang, length(text) AS chars, md5(text) AS text_md5 FROM documents""")
def large_quoted_csv(t):
    """As above, each file read by as many tasks as it has splits."""
    path = t.scratch("csv")
    writers.write_quoted_csv(t.documents.select("doc_id", "lang", "text"), path)
    back = splitting.read_quoted_csv(t.spark, path, "doc_id BIGINT, lang STRING, text STRING")
    return back.select(
        "doc_id", "lang", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("text_md5")
    )


PAGE_IDS_SQL = "regexp_extract(url, '([^/?]+)(\\?[^/]*)?$', 1)"


@query("src_14_id_list", """
    SELECT CAST(doc_id AS VARCHAR) AS id FROM documents
    UNION SELECT CAST(page_id AS VARCHAR) FROM pages""")
def id_list(t):
    """A written list whose cells are ids, repeats, blanks and words."""
    path = t.scratch("ids")
    ids = t.documents.select(F.col("doc_id").cast("string").alias("id"), "source")
    more = t.pages.select(F.concat(F.lit(" "), F.col("page_id").cast("string")).alias("id"), F.lit("crawl").alias("source"))
    words = t.pages.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"), F.lit("").alias("source"))
    ids.unionByName(more).unionByName(words).write.option("header", True).csv(path)
    return readers.read_id_list(t.spark, path).select("id")


@query("snk_01_append", "SELECT s_suppkey, CAST(2 AS BIGINT) AS copies FROM supplier")
def append(t):
    path = t.scratch("append")
    writers.append_parquet(t.supplier, path)
    writers.append_parquet(t.supplier, path)
    return t.spark.read.parquet(path).groupBy("s_suppkey").agg(F.count("*").alias("copies"))


@query("snk_02_overwrite", "SELECT * FROM part")
def overwrite(t):
    path = t.scratch("overwrite")
    writers.overwrite_parquet(t.part.limit(0), path)
    writers.overwrite_parquet(t.part, path)
    return t.spark.read.parquet(path)


@query("snk_03_external_table", "SELECT * FROM customer")
def external_table(t):
    table = f"{fresh_database(t, 'external')}.customer"
    catalog.save_external(t.customer, table, t.scratch("customer"))
    return t.spark.table(table)


@query("snk_04_register_location", "SELECT * FROM part")
def register_location(t):
    path, table = t.scratch("part"), f"{fresh_database(t, 'register')}.part"
    writers.overwrite_parquet(t.part, path)
    catalog.register_location(t.spark, table, path)
    return t.spark.table(table)


@query("snk_05_recreate_database", """
    SELECT 'supplier' AS table_name, count(*) AS n FROM supplier""")
def recreate_database(t):
    name = fresh_database(t, "recreate")
    catalog.rebuild_model(t.nation, f"{name}.nation")
    catalog.recreate_database(t.spark, name, t.scratch(name))
    catalog.rebuild_model(t.supplier, f"{name}.supplier")
    (left,) = [x for x in t.spark.catalog.listTables(name) if not x.isTemporary]
    return t.spark.table(f"{name}.{left.name}").agg(
        F.lit(left.name).alias("table_name"), F.count("*").alias("n")
    )


@query("snk_06_stream_to_parquet", "SELECT * FROM orders")
def stream_to_parquet(t):
    out = t.scratch("sink")
    stream = t.spark.readStream.schema(ORDERS).parquet(t.arrivals("orders"))
    feeds.await_all([feeds.write_feed(stream, f"{out}/data", f"{out}/checkpoint", drain=True)])
    return t.spark.read.schema(ORDERS).parquet(f"{out}/data")


@query("snk_07_csv_with_header", "SELECT p_partkey, p_name, p_retailprice FROM part")
def csv_with_header(t):
    path = t.scratch("csv")
    writers.write_csv(t.part.select("p_partkey", "p_name", "p_retailprice"), path)
    return readers.read_csv(t.spark, path, "p_partkey BIGINT, p_name STRING, p_retailprice DOUBLE")


@query("snk_08_split_json_lines", """
    SELECT CASE WHEN c_acctbal < 0 THEN 'NegativeBalance' END AS error, count(*) AS n
    FROM customer GROUP BY 1""")
def split_json_lines(t):
    good, bad = t.scratch("good"), t.scratch("bad")
    reason = F.when(F.col("c_acctbal") < 0, F.lit("NegativeBalance"))
    writers.write_split(t.customer, reason, good, bad, "c_custkey")
    kept = t.spark.read.schema(CUSTOMER).json(good).select(
        F.col("c_custkey").cast("string").alias("id"), F.lit(None).cast("string").alias("error")
    )
    rejected = t.spark.read.schema("id STRING, error STRING").json(bad)
    return kept.unionByName(rejected).groupBy("error").agg(F.count("*").alias("n"))


@query("snk_09_append_rows", """
    SELECT url AS link, 'Page ' || page_id AS title, CAST(NULL AS VARCHAR) AS description
    FROM pages""")
def append_rows(t):
    table = f"{fresh_database(t, 'episodes')}.episodes"
    rows = t.pages.select(
        F.concat(F.lit("Page "), "page_id").alias("title"), F.col("url").alias("link")
    )
    empty = t.spark.createDataFrame([], "link STRING, title STRING, description STRING")
    catalog.rebuild_model(empty, table)
    catalog.append_rows(rows, table)
    return t.spark.table(table)


@query("snk_10_rebuild_model", """
    SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY 1""")
def rebuild_model(t):
    table = f"{fresh_database(t, 'model')}.customer_orders"
    model = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n_orders"))
    catalog.rebuild_model(model.limit(0), table)
    catalog.rebuild_model(model, table)
    return t.spark.table(table)
