"""Projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.functions import semi, text, values
from tidemill.operators import filters
from tidemill.plans.ingest import delta_tree
from tidemill.plans.registry import query


@query("prj_01_select_columns", """
    SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate FROM lineitem""")
def select_columns(t):
    return t.lineitem.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )


@query("prj_02_pass_through", "SELECT * FROM part")
def pass_through(t):
    return t.part


@query("prj_03_rename", """
    SELECT c_custkey AS customer_id, c_name AS name, c_nationkey AS nation_id, c_acctbal, c_mktsegment
    FROM customer""")
def rename(t):
    return t.customer.withColumnsRenamed(
        {"c_custkey": "customer_id", "c_name": "name", "c_nationkey": "nation_id"}
    )


@query("prj_04_drop_columns", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def drop_columns(t):
    return t.customer.drop("c_acctbal", "c_nationkey", "_rescued_data")


@query("prj_05_computed_columns", """
    SELECT l_orderkey, l_linenumber, l_quantity * p_retailprice AS total_purchase_value
    FROM lineitem JOIN part ON l_partkey = p_partkey""")
def computed_columns(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    value = values.line_value(F.col("l_quantity"), F.col("p_retailprice"))
    return joined.select("l_orderkey", "l_linenumber", value.alias("total_purchase_value"))


@query("prj_06_literal_columns", """
    SELECT s_suppkey, 0 AS dim_key, ' ' AS gap, CAST(1 AS BIGINT) AS step FROM supplier""")
def literal_columns(t):
    return t.supplier.select(
        "s_suppkey", F.lit(0).alias("dim_key"), F.lit(" ").alias("gap"),
        F.lit(1).cast("bigint").alias("step"),
    )


@query("prj_07_struct_expansion", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def struct_expansion(t):
    data = F.from_json("props", "k BIGINT").alias("data")
    return t.events.select("event_id", data).select("event_id", "data.*")


@query("prj_08_empty_relation", """
    SELECT count(*) AS n FROM (SELECT c_custkey FROM customer WHERE 1 = 0)""")
def empty_relation(t):
    first_load = t.customer.select(
        F.lit(0).alias("DimCustomerKey"), "c_custkey", F.current_timestamp().alias("create_date")
    ).where("1 = 0")
    return first_load.agg(F.count("*").alias("n"))


@query("prj_09_aliases", """
    SELECT trg.o_orderkey, src.c_name FROM orders AS trg JOIN customer AS src
    ON trg.o_custkey = src.c_custkey""")
def aliases(t):
    joined = t.orders.alias("trg").join(
        t.customer.alias("src"), F.col("trg.o_custkey") == F.col("src.c_custkey")
    )
    return joined.select("trg.o_orderkey", "src.c_name")


@query("prj_10_temp_view", """
    SELECT p_brand, count(*) AS n, min(p_retailprice) AS cheapest FROM part GROUP BY p_brand""")
def temp_view(t):
    t.part.createOrReplaceTempView("tidemill_products")
    return t.spark.sql(
        "SELECT p_brand, count(*) AS n, min(p_retailprice) AS cheapest FROM tidemill_products GROUP BY p_brand"
    )


@query("prj_11_cte", """
    WITH fact_base AS (
        SELECT o_custkey, o_totalprice FROM orders)
    SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM fact_base GROUP BY 1""")
def cte(t):
    return t.spark.sql("""
        WITH fact_base AS (
            SELECT o_custkey, o_totalprice FROM {orders})
        SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total
        FROM fact_base GROUP BY o_custkey""", orders=t.orders)


@query("flt_01_equality", "SELECT * FROM customer WHERE c_mktsegment = 'AUTOMOBILE'")
def equality(t):
    return t.customer.filter(F.col("c_mktsegment") == "AUTOMOBILE")


@query("flt_02_threshold", "SELECT event_id, value FROM events WHERE value > 7.5")
def threshold(t):
    return t.events.filter(F.col("value") > 7.5).select("event_id", "value")


@query("flt_03_null_split", """
    SELECT d.doc_id, CASE WHEN quality IS NULL THEN 'new' ELSE 'existing' END AS kind
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def null_split(t):
    joined = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    kind = F.when(F.col("quality").isNull(), "new").otherwise("existing")
    return joined.select("doc_id", kind.alias("kind"))


@query("flt_04_valid_rows", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0")
def valid_rows(t):
    return filters.valid_measures(t.customer, "c_acctbal").select("c_custkey", "c_acctbal")


@query("flt_04_not_negative", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def not_negative(t):
    return filters.valid_measures(t.customer, "c_acctbal", zero=True).select("c_custkey", "c_acctbal")


@query("flt_05_substring_any_case", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%WIDGET%'")
def substring_any_case(t):
    return t.part.filter(F.ilike("p_name", F.lit("%WIDGET%"))).select("p_partkey", "p_name")


@query("flt_06_digits_only", r"""
    SELECT page_id, cell FROM (
        SELECT page_id, regexp_extract(url, '([^/?]+)(\?[^/]*)?$', 1) AS cell FROM pages)
    WHERE regexp_matches(cell, '^[0-9]+$')""")
def digits_only(t):
    cells = t.pages.select("page_id", F.regexp_extract("url", r"([^/?]+)(\?[^/]*)?$", 1).alias("cell"))
    return cells.filter(filters.digits_only(F.col("cell")))


@query("flt_07_blank_removal", r"""
    SELECT doc_id, count(*) AS filled_lines FROM (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE regexp_matches(line, '\S') GROUP BY doc_id""")
def blank_removal(t):
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return filters.drop_blank(lines, "line").groupBy("doc_id").agg(F.count("*").alias("filled_lines"))


@query("str_01_split_part", """
    SELECT p_partkey, string_split(p_name, ' ')[1] AS zone1, string_split(p_name, ' ')[2] AS zone2,
           string_split(p_name, ' ')[3] AS zone3 FROM part""")
def split_part(t):
    parts = [text.part(F.col("p_name"), " ", i).alias(f"zone{i + 1}") for i in range(3)]
    return t.part.select("p_partkey", *parts)


@query("str_02_domain", """
    SELECT page_id, string_split(url, '/')[3] AS host,
           string_split('page' || page_id || '@' || string_split(url, '/')[3], '@')[2] AS domain
    FROM pages""")
def domain(t):
    host = text.part(F.col("url"), "/", 2)
    email = F.concat(F.lit("page"), F.col("page_id"), F.lit("@"), host)
    return t.pages.select("page_id", host.alias("host"), text.email_domain(email).alias("domain"))


@query("str_03_full_name", """
    SELECT c_custkey, c_name || ' ' || c_mktsegment AS full_name,
           c_name || ' ' || CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS name_if_positive
    FROM customer""")
def full_name(t):
    segment = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))
    return t.customer.select(
        "c_custkey",
        text.full_name(F.col("c_name"), F.col("c_mktsegment")).alias("full_name"),
        text.full_name(F.col("c_name"), segment).alias("name_if_positive"),
    )


@query("str_04_upper", "SELECT p_partkey, upper(p_brand) AS brand_upper FROM part")
def upper(t):
    return t.part.select("p_partkey", F.upper("p_brand").alias("brand_upper"))


@query("str_05_squeeze", r"""
    SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS squeezed_md5 FROM documents""")
def squeeze(t):
    return t.documents.select("doc_id", F.md5(text.squeeze(F.col("text"))).alias("squeezed_md5"))


@query("str_06_last_segment", """
    SELECT page_id, list_last(string_split(url, '/')) || '.mp3' AS filename FROM pages""")
def last_segment(t):
    name = F.concat(text.last_segment(F.col("url")), F.lit(".mp3"))
    return t.pages.select("page_id", name.alias("filename"))


@query("str_07_first_truthy", """
    SELECT c_custkey, coalesce(nullif(CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal > 5000 THEN NULL
        ELSE c_name END, ''), nullif(c_mktsegment, '')) AS label FROM customer""")
def first_truthy(t):
    name = F.when(F.col("c_acctbal") < 0, "").when(F.col("c_acctbal") <= 5000, F.col("c_name"))
    return t.customer.select("c_custkey", text.first_truthy(name, F.col("c_mktsegment")).alias("label"))


@query("str_12_list_items", """
    SELECT p_partkey, item FROM (
        SELECT p_partkey, unnest(string_split(p_name || ' ' || p_type, ' ')) AS item FROM part)""")
def list_items(t):
    words = F.split(F.concat_ws(" ", "p_name", "p_type"), " ")
    quoted = F.transform(words, lambda w: F.concat(F.lit("'"), w, F.lit("'")))
    named = F.transform(words, lambda w: F.concat(F.lit("{'id': 1, 'name': '"), w, F.lit("'}")))
    packed = (
        F.when(F.col("p_size") < 13, F.array_join(words, "|"))
        .when(F.col("p_size") < 26, F.array_join(words, ", "))
        .when(F.col("p_size") < 39, F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))
        .otherwise(F.concat(F.lit("["), F.array_join(named, ", "), F.lit("]")))
    )
    return t.part.select("p_partkey", F.explode(semi.list_items(packed)).alias("item"))


@query("str_13_unquoted_items", """
    SELECT p_partkey, unnest(string_split(p_name || ' ' || p_type, ' ')) AS item FROM part""")
def unquoted_items(t):
    words = F.split(F.concat_ws(" ", "p_name", "p_type"), " ")
    quoted = F.transform(words, lambda w: F.concat(F.lit("'"), w, F.lit("'")))
    packed = F.when(F.col("p_size") < 25, F.array_join(words, "|")).otherwise(
        F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))
    )
    return t.part.select("p_partkey", F.explode(semi.unquoted_items(packed)).alias("item"))


@query("str_14_email_autofill", f"""
    SELECT c_custkey, regexp_matches(email, '{text.EMAIL_PATTERN}') AS valid,
           CASE WHEN regexp_matches(email, '{text.EMAIL_PATTERN}') THEN email
                ELSE name || '@default.com' END AS email
    FROM (SELECT c_custkey, name, CASE WHEN c_nationkey < 8 THEN name || '@mail.example.com'
              WHEN c_nationkey < 16 THEN name || '@nowhere' ELSE name END AS email
          FROM (SELECT *, replace(lower(c_name), '#', '.') AS name FROM customer))""")
def email_autofill(t):
    named = t.customer.withColumn("name", F.replace(F.lower("c_name"), F.lit("#"), F.lit(".")))
    email = (
        F.when(F.col("c_nationkey") < 8, F.concat("name", F.lit("@mail.example.com")))
        .when(F.col("c_nationkey") < 16, F.concat("name", F.lit("@nowhere")))
        .otherwise(F.col("name"))
    )
    named = named.withColumn("given", email)
    return named.select(
        "c_custkey",
        text.valid_email(F.col("given")).alias("valid"),
        text.email_or_default(F.col("name"), F.col("given")).alias("email"),
    )


@query("str_15_default_text", """
    SELECT c_custkey, coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, 'N/A') AS segment
    FROM customer""")
def default_text(t):
    segment = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", text.or_missing(segment).alias("segment"))


@query("str_16_name_from_path", """
    SELECT 'orders' AS table_name, strftime(o_orderdate, '%Y') || '0101' AS batch_date,
           CASE WHEN o_orderstatus = 'F' THEN '00' ELSE '01' END AS batch_hour, count(*) AS n
    FROM orders GROUP BY 1, 2, 3""")
def name_from_path(t):
    return delta_tree(t).groupBy("table_name", "batch_date", "batch_hour").agg(F.count("*").alias("n"))


@query("dt_01_to_timestamp", "SELECT o_orderkey, o_orderdate AS parsed FROM orders")
def to_timestamp(t):
    written = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    parsed = F.to_timestamp(written).cast("timestamp_ntz")
    return t.orders.select("o_orderkey", parsed.alias("parsed"))


@query("dt_02_date_parts", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS trip_date, CAST(year(o_orderdate) AS BIGINT) AS year,
           CAST(month(o_orderdate) AS BIGINT) AS month FROM orders""")
def date_parts(t):
    return t.orders.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("trip_date"),
        F.year("o_orderdate").cast("bigint").alias("year"),
        F.month("o_orderdate").cast("bigint").alias("month"),
    )


@query("dt_03_lenient_date", """
    SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderdate END AS parsed FROM orders""")
def lenient_date(t):
    written = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("soon"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    parsed = values.to_moment(written, "yyyy-MM-dd", "MM/dd/yyyy").cast("timestamp_ntz")
    return t.orders.select("o_orderkey", parsed.alias("parsed"))


@query("dt_04_age", """
    SELECT o_orderkey, CAST(date_diff('year', CAST(o_orderdate AS DATE), DATE '2024-06-15')
        - CASE WHEN strftime(o_orderdate, '%m%d') > '0615' THEN 1 ELSE 0 END AS INTEGER) AS age
    FROM orders""")
def age(t):
    years = values.age_in_years(F.to_date("o_orderdate"), F.lit("2024-06-15").cast("date"))
    return t.orders.select("o_orderkey", years.alias("age"))


@query("dt_05_date_and_text", """
    SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS written, CAST(o_orderdate AS DATE) AS read_back
    FROM orders""")
def date_and_text(t):
    written = F.date_format("o_orderdate", "dd/MM/yyyy")
    return t.orders.select(
        "o_orderkey", written.alias("written"), F.to_date(written, "dd/MM/yyyy").alias("read_back")
    )


@query("dt_06_delivery_delay", """
    SELECT l_orderkey, l_linenumber,
           CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS BIGINT) AS delay,
           date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) > 30 AS late
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def delivery_delay(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    delay = values.delay_in_days(F.to_date("o_orderdate"), F.to_date("l_shipdate"))
    return joined.select(
        "l_orderkey", "l_linenumber", delay.cast("bigint").alias("delay"), (delay > 30).alias("late")
    )


@query("dt_07_load_time", """
    SELECT s_suppkey, TIMESTAMP '2025-01-01 00:00:00' AS update_date FROM supplier""")
def load_time(t):
    now = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    return t.supplier.select("s_suppkey", now.alias("update_date"))


@query("mth_01_arithmetic", """
    SELECT p_partkey, round(p_retailprice * 0.90, 4) AS discounted,
           round(p_retailprice - p_size, 4) AS unit_margin, p_size * p_retailprice AS stock_value FROM part""")
def arithmetic(t):
    price = F.col("p_retailprice")
    return t.part.select(
        "p_partkey",
        F.round(values.discounted(price), 4).alias("discounted"),
        F.round(values.profit(price, F.col("p_size"), fill=None), 4).alias("unit_margin"),
        values.line_value(F.col("p_size"), price).alias("stock_value"),
    )


@query("mth_02_lenient_number", """
    SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_acctbal END AS amount FROM customer""")
def lenient_number(t):
    written = F.when(F.col("c_nationkey") == 3, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    return t.customer.select("c_custkey", values.to_number(written).alias("amount"))


@query("mth_03_fill_missing", """
    SELECT c_custkey, coalesce(revenue, 0) - 10.0 AS filled, revenue - 10.0 AS unfilled
    FROM (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS revenue FROM customer)""")
def fill_missing(t):
    revenue = F.when(F.col("c_acctbal") > 0, F.col("c_acctbal"))
    return t.customer.select(
        "c_custkey",
        values.profit(revenue, F.lit(10.0)).alias("filled"),
        values.profit(revenue, F.lit(10.0), fill=None).alias("unfilled"),
    )


@query("cnd_01_rules", """
    SELECT p_partkey, CASE WHEN p_retailprice < 950 THEN 'low' WHEN p_retailprice < 1050 THEN 'middle'
        WHEN p_size > 40 THEN 'bulky' ELSE 'high' END AS band FROM part""")
def rules(t):
    price = F.col("p_retailprice")
    band = values.first_match(
        [(price < 950, "low"), (price < 1050, "middle"), (F.col("p_size") > 40, "bulky")], "high"
    )
    return t.part.select("p_partkey", band.alias("band"))


@query("arr_01_explode", """
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part""")
def explode(t):
    return t.part.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))


@query("arr_02_first_element", """
    SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first FROM embeddings""")
def first_element(t):
    return t.embeddings.select("vec_id", F.get("embedding", F.lit(0)).cast("double").alias("first"))


@query("jsn_01_decode", """
    SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def decode(t):
    return t.events.select("event_id", F.from_json("props", "k BIGINT").getField("k").alias("k"))


@query("jsn_03_encode", """
    SELECT s_suppkey, '{"s_suppkey":' || s_suppkey || ',"s_name":"' || s_name || '"}' AS record
    FROM supplier""")
def encode(t):
    return t.supplier.select("s_suppkey", F.to_json(F.struct("s_suppkey", "s_name")).alias("record"))


@query("udf_01_sql_function", """
    SELECT p_partkey, p_retailprice * 0.90 AS discounted_price FROM part""")
def sql_function(t):
    t.spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION discount_func(price DOUBLE) RETURNS DOUBLE "
        "RETURN price * 0.90D"
    )
    return t.part.select("p_partkey", F.expr("discount_func(p_retailprice)").alias("discounted_price"))


@query("udf_02_sql_string_function", "SELECT p_partkey, upper(p_brand) AS brand_upper FROM part")
def sql_string_function(t):
    t.spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION upper_func(brand STRING) RETURNS STRING RETURN upper(brand)"
    )
    return t.part.select("p_partkey", F.expr("upper_func(p_brand)").alias("brand_upper"))
