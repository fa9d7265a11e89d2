"""Counts, totals, extremes and the figures behind dashboards."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemill.functions import text
from tidemill.operators import aggregates, quality
from tidemill.plans.joining import TRIPS_SQL, transactions, trips
from tidemill.plans.registry import query

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("agg_01_group_count", """
    SELECT string_split(url, '/')[3] AS domain, count(*) AS total FROM pages GROUP BY 1""")
def group_count(t):
    return aggregates.value_counts(t.pages, text.part(F.col("url"), "/", 2), "domain", "total")


@query("agg_02_last_per_group", """
    SELECT c_custkey AS user_id, c_name AS name, max(o_orderdate) AS last_transaction FROM customer
    LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2""")
def last_per_group(t):
    # Reduce to one row per user before the join, so a user with many orders costs no more.
    last = (
        t.orders.groupBy("o_custkey")
        .agg(F.max("o_orderdate").alias("last_transaction"))
    )
    return t.customer.join(last, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), "last_transaction"
    )


@query("agg_03_total", "SELECT round(sum(o_totalprice), 2) AS total FROM orders")
def total(t):
    return t.orders.agg(F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("agg_04_maximum_with_default", """
    SELECT n_nationkey, (SELECT coalesce(max(o_orderkey), 0) FROM orders) AS last_key,
           (SELECT coalesce(max(o_orderdate), TIMESTAMP '1970-01-01') FROM orders WHERE o_totalprice < 0) AS mark
    FROM nation""")
def maximum_with_default(t):
    never = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return t.nation.select(
        "n_nationkey",
        aggregates.maximum(t.orders, "o_orderkey", F.lit(0)).alias("last_key"),
        aggregates.maximum(t.orders.filter("o_totalprice < 0"), "o_orderdate", never).alias("mark"),
    )


@query("agg_05_extreme_row", """
    (SELECT 'most' AS kind, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1)
    UNION ALL
    (SELECT 'least', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1)""")
def extreme_row(t):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    most = orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(1)
    least = orders.orderBy("o_totalprice", "o_orderkey").limit(1)
    kind = lambda df, label: df.select(F.lit(label).alias("kind"), "*")
    return kind(most, "most").unionByName(kind(least, "least"))


@query("agg_06_extreme_rows_with_ties", """
    SELECT p_partkey, p_size, p_size = (SELECT max(p_size) FROM part) AS largest FROM part
    WHERE p_size = (SELECT max(p_size) FROM part) OR p_size = (SELECT min(p_size) FROM part)""")
def extreme_rows_with_ties(t):
    parts = t.part.select("p_partkey", "p_size")
    large = aggregates.extreme_rows(parts, "p_size").withColumn("largest", F.lit(True))
    small = aggregates.extreme_rows(parts, "p_size", largest=False).withColumn("largest", F.lit(False))
    return large.unionByName(small)


@query("agg_07_row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(t):
    return t.lineitem.agg(F.count("*").alias("n"))


@query("agg_08_value_counts", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1")
def value_counts(t):
    return aggregates.value_counts(t.part, F.col("p_brand"), "p_brand")


@query("agg_09_item_counts", r"""
    SELECT word, count(*) AS n FROM (
        SELECT unnest(regexp_split_to_array(text, '\s+')) AS word FROM documents)
    WHERE word <> '' GROUP BY 1""")
def item_counts(t):
    return aggregates.item_counts(t.documents, F.split("text", r"\s+"), "word")


@query("agg_10_error_tally", """
    WITH e AS (SELECT json_extract_string(props, '$.k') AS error FROM events WHERE event_type = 'error')
    SELECT error, count(*) AS n FROM e GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM e""")
def error_tally(t):
    errors = t.events.filter("event_type = 'error'").select(F.get_json_object("props", "$.k").alias("error"))
    return quality.error_tally(errors)


@query("agg_11_product_year", """
    SELECT p_brand, p_type, CAST(year(l_shipdate) AS BIGINT) AS year, round(sum(l_extendedprice), 2) AS total,
           count(*) AS n, round(avg(l_quantity), 6) AS avg_quantity
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3""")
def product_year(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.groupBy("p_brand", "p_type", F.year("l_shipdate").cast("bigint").alias("year")).agg(
        F.round(F.sum("l_extendedprice"), 2).alias("total"),
        F.count("*").alias("n"),
        F.round(F.avg("l_quantity"), 6).alias("avg_quantity"),
    )


@query("agg_12_monthly_figures", """
    SELECT date_trunc('month', o_orderdate) AS month, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
           round(sum(l_extendedprice * (1 - l_discount) - l_quantity * p_retailprice), 4) AS profit,
           count(DISTINCT o_orderkey) AS n_orders
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    GROUP BY 1""")
def monthly_figures(t):
    """Revenue, profit and orders per month; each order is first reduced to one row."""
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    cost = F.col("l_quantity") * F.col("p_retailprice")
    per_order = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_orderkey").agg(F.sum(revenue).alias("revenue"), F.sum(revenue - cost).alias("profit"))
    )
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")
    return (
        per_order.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(month)
        .agg(
            F.round(F.sum("revenue"), 4).alias("revenue"),
            F.round(F.sum("profit"), 4).alias("profit"),
            F.count("*").alias("n_orders"),
        )
    )


@query("agg_13_key_figures", """
    SELECT count(*) AS trips, round(sum(l_extendedprice), 2) AS revenue, round(avg(l_extendedprice), 6) AS avg_fare,
           round(avg(l_quantity), 6) AS avg_distance FROM lineitem""")
def key_figures(t):
    return t.lineitem.agg(
        F.count("*").alias("trips"),
        F.round(F.sum("l_extendedprice"), 2).alias("revenue"),
        F.round(F.avg("l_extendedprice"), 6).alias("avg_fare"),
        F.round(F.avg("l_quantity"), 6).alias("avg_distance"),
    )


@query("agg_14_revenue_by_place", f"""
    WITH {TRIPS_SQL}
    SELECT 'borough' AS level, pickup_borough AS place, round(sum(fare), 2) AS revenue, count(*) AS trips FROM trips GROUP BY 2
    UNION ALL SELECT 'zone', pickup_zone, round(sum(fare), 2), count(*) FROM trips GROUP BY 2
    UNION ALL SELECT 'vendor', CAST(vendor AS VARCHAR), round(sum(fare), 2), count(*) FROM trips GROUP BY 2""")
def revenue_by_place(t):
    """Three totals from one pass: vendors first, then their zones and boroughs."""
    vendors = trips(t).groupBy("vendor", "pickup_zone", "pickup_borough").agg(
        F.sum("fare").alias("fare"), F.count("*").alias("trips")
    )
    levels = F.array(*[
        F.struct(F.lit(level).alias("level"), F.col(column).cast("string").alias("place"))
        for level, column in (("borough", "pickup_borough"), ("zone", "pickup_zone"), ("vendor", "vendor"))
    ])
    return (
        vendors.select("fare", "trips", F.inline(levels)).groupBy("level", "place")
        .agg(F.round(F.sum("fare"), 2).alias("revenue"), F.sum("trips").alias("trips"))
    )


@query("agg_15_flow_matrix", "WITH " + TRIPS_SQL + " SELECT pickup_borough, " + ", ".join(
    f"""count(*) FILTER (WHERE dropoff_borough = '{r}') AS "{r}" """ for r in REGIONS
) + """, count(*) FILTER (WHERE dropoff_borough IS NULL OR dropoff_borough NOT IN (""" + ", ".join(
    f"'{r}'" for r in REGIONS) + """)) AS other FROM trips GROUP BY 1""")
def flow_matrix(t):
    return aggregates.flow_matrix(trips(t), "pickup_borough", "dropoff_borough", REGIONS)


PROFILED = ["l_quantity", "l_extendedprice", "l_discount"]


@query("agg_16_column_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS filled, round(avg({c}), 6) AS mean,
        round(stddev({c}), 6) AS deviation, min({c}) AS least, max({c}) AS greatest FROM lineitem"""
    for c in PROFILED))
def column_profile(t):
    profile = aggregates.column_profile(t.lineitem, PROFILED)
    return profile.withColumns({"mean": F.round("mean", 6), "deviation": F.round("deviation", 6)})


@query("agg_16_quartiles", " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({s} AS DOUBLE) AS share, round(quantile_cont({c}, {s}), 6) AS value FROM lineitem"""
    for c in PROFILED for s in (0.25, 0.5, 0.75)))
def quartiles(t):
    found = aggregates.exact_quantiles(t.lineitem, PROFILED, [0.25, 0.5, 0.75])
    return found.withColumn("value", F.round("value", 6))


@query("srt_06_top_groups_of_many", """
    SELECT l_partkey, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1
    ORDER BY quantity DESC, l_partkey LIMIT 25""")
def top_groups_of_many(t):
    found = aggregates.top_groups(t.lineitem, "l_partkey", F.col("l_quantity").cast("long"), "quantity", 25)
    return found.select("l_partkey", "quantity")


@query("agg_17_dataset_summary", """
    SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_columns, max(o_totalprice) AS most, min(o_totalprice) AS least,
           round(sum(o_totalprice), 2) AS total, arg_max(o_orderkey, o_totalprice) AS most_key
    FROM orders""")
def dataset_summary(t):
    return t.orders.agg(
        F.count("*").alias("n_rows"),
        F.lit(len(t.orders.columns)).cast("bigint").alias("n_columns"),
        F.max("o_totalprice").alias("most"),
        F.min("o_totalprice").alias("least"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.max_by("o_orderkey", "o_totalprice").alias("most_key"),
    )


@query("agg_18_segment_share", """
    SELECT o_orderstatus, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
    FROM orders GROUP BY 1""")
def segment_share(t):
    counted = t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return aggregates.with_share(counted, "n", "share").withColumn("share", F.round("share", 6))


@query("srt_04_sort_by_count", """
    SELECT c_mktsegment, count(*) AS total_customers, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) AS place
    FROM customer GROUP BY 1""")
def sort_by_count(t):
    counted = t.customer.groupBy("c_mktsegment").agg(F.count("*").alias("total_customers"))
    # One row per segment is left, so one task may number them.
    order = Window.orderBy(F.desc("total_customers"), "c_mktsegment")
    return counted.withColumn("place", F.row_number().over(order).cast("bigint")).orderBy("place")


@query("srt_02_top_profit", """
    SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice - l_quantity * p_retailprice, 2) AS profit
    FROM lineitem JOIN part ON l_partkey = p_partkey
    ORDER BY profit DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10""")
def top_profit(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    profit = F.round(F.col("l_extendedprice") - F.col("l_quantity") * F.col("p_retailprice"), 2)
    return (
        joined.select("l_orderkey", "l_linenumber", "l_partkey", profit.alias("profit"))
        .orderBy(F.desc("profit"), "l_orderkey", "l_linenumber", "l_partkey").limit(10)
    )


@query("srt_03_top_price", """
    SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 10""")
def top_price(t):
    return (
        t.part.select("p_partkey", "p_name", "p_retailprice")
        .orderBy(F.desc_nulls_last("p_retailprice"), "p_partkey").limit(10)
    )


@query("srt_05_limit", "SELECT * FROM customer ORDER BY c_custkey LIMIT 20")
def limit(t):
    return t.customer.orderBy("c_custkey").limit(20)


@query("srt_06_top_groups", f"""
    WITH {TRIPS_SQL},
    zones AS (SELECT pickup_borough, pickup_zone, count(*) AS trips, round(sum(fare), 2) AS revenue
              FROM trips GROUP BY 1, 2)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY pickup_borough
        ORDER BY trips DESC, pickup_zone) AS rank FROM zones) WHERE rank <= 3""")
def top_groups(t):
    zones = trips(t).groupBy("pickup_borough", "pickup_zone").agg(
        F.count("*").alias("trips"), F.round(F.sum("fare"), 2).alias("revenue")
    )
    top = aggregates.top_per_group(zones, ["pickup_borough"], [F.desc("trips"), F.col("pickup_zone")], 3)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


@query("srt_06_top_customers", """
    SELECT c_custkey, c_name, round(sum(o_totalprice), 2) AS spent, count(*) AS n_orders
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2 ORDER BY spent DESC, c_custkey LIMIT 50""")
def top_customers(t):
    spent = t.orders.groupBy("o_custkey").agg(
        F.round(F.sum("o_totalprice"), 2).alias("spent"), F.count("*").alias("n_orders")
    )
    joined = spent.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.select("c_custkey", "c_name", "spent", "n_orders").orderBy(F.desc("spent"), "c_custkey").limit(50)


@query("agg_02_transaction_totals", """
    SELECT o_custkey AS user_id, count(*) AS items, round(sum(l_quantity * p_retailprice), 4) AS spent,
           max(o_orderdate) AS last_order
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def transaction_totals(t):
    return transactions(t).groupBy("user_id").agg(
        F.count("*").alias("items"),
        F.round(F.sum("total_purchase_value"), 4).alias("spent"),
        F.max("order_date").alias("last_order"),
    )
