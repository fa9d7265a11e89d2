"""Data quality rules, quarantine, reconciliation and retries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemill.operators import quality
from tidemill.plans.registry import query
from tidemill.schemas import STORE_RULES
from tidemill.sources import writers

CHECKS = {
    "customer": (["c_custkey", "c_name", "c_acctbal"], ["c_custkey"]),
    "orders": (["o_orderkey", "o_custkey", "o_orderdate"], ["o_orderkey"]),
    "lineitem": (["l_orderkey", "l_partkey"], ["l_orderkey", "l_linenumber"]),
}


def check_sql(table: str, filled: list[str], unique: list[str]) -> str:
    keys = ", ".join(unique)
    rows = [
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, 'not_null' AS rule, "
        f"count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {table}"
        for c in filled
    ]
    rows.append(
        f"SELECT '{table}', '{','.join(unique)}', 'unique', count(*) FROM "
        f"(SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1)"
    )
    return " UNION ALL ".join(rows)


@query("dq_01_column_tests", " UNION ALL ".join(check_sql(n, *rule) for n, rule in CHECKS.items()))
def column_tests(t):
    report = None
    for name, (filled, unique) in CHECKS.items():
        one = quality.check_table(getattr(t, name), name, filled, [unique])
        report = one if report is None else report.unionByName(one)
    return report


def store(t):
    """The given tables in the shapes of the store tables; one item has no goods, one user no name."""
    at = [F.col("at").alias("created_at"), F.col("at").alias("updated_at")]
    dated = lambda df, day: df.withColumn("at", day)
    now = F.lit("2024-10-31 14:00:00").cast("timestamp_ntz")
    return {
        "users": dated(t.customer, now).select(
            F.col("c_custkey").alias("id"), F.nullif("c_name", F.lit("Customer#000000001")).alias("name"),
            F.col("c_mktsegment").alias("email"), F.col("c_nationkey").alias("phone"), *at),
        "orders": dated(t.orders, F.col("o_orderdate")).select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"),
            (F.col("o_orderstatus") == "F").alias("is_refund"), *at),
        "order_item": dated(t.lineitem, F.col("l_shipdate")).select(
            F.col("l_linenumber").alias("id"), F.col("l_orderkey").alias("order_id"),
            F.nullif("l_partkey", F.lit(1)).alias("goods_id"), F.col("l_quantity").alias("qty"), *at),
        "goods": dated(t.part, now).select(
            F.col("p_partkey").alias("id"), F.col("p_size").alias("category_id"), F.col("p_name").alias("name"),
            F.col("p_retailprice").alias("price"), *at),
        "categories": dated(t.nation, now).select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), *at),
    }


STORE_SQL = """
    WITH users AS (SELECT c_custkey AS id, NULLIF(c_name, 'Customer#000000001') AS name, c_mktsegment AS email,
            c_nationkey AS phone, 1 AS created_at, 1 AS updated_at FROM customer),
    sales AS (SELECT o_orderkey AS id, o_custkey AS user_id, o_orderstatus AS is_refund, o_orderdate AS created_at,
            o_orderdate AS updated_at FROM orders),
    order_item AS (SELECT l_linenumber AS id, l_orderkey AS order_id, NULLIF(l_partkey, 1) AS goods_id, l_quantity AS qty,
            l_shipdate AS created_at, l_shipdate AS updated_at FROM lineitem),
    goods AS (SELECT p_partkey AS id, p_size AS category_id, p_name AS name, p_retailprice AS price, 1 AS created_at,
            1 AS updated_at FROM part),
    categories AS (SELECT n_nationkey AS id, n_name AS name, 1 AS created_at, 1 AS updated_at FROM nation) """


@query("dq_01_store_rules", STORE_SQL + " UNION ALL ".join(
    check_sql("sales" if name == "orders" else name, *rule).replace("'sales'", "'orders'") for name, rule in STORE_RULES.items()))
def store_rules(t):
    return quality.check_store(store(t))


RULES = {
    "has_name": "c_name IS NOT NULL",
    "positive_balance": "c_acctbal > 0",
    "known_nation": "nullif(c_nationkey, 3) BETWEEN 0 AND 24",
}


@query("dq_02_expect_or_drop", """
    SELECT c_custkey FROM customer WHERE c_name IS NOT NULL AND c_acctbal > 0 AND c_nationkey <> 3""")
def expect_or_drop(t):
    return quality.keep_expected(t.customer, RULES).select("c_custkey")


@query("dq_02_rule_failures", """
    SELECT 'has_name' AS rule, count(*) FILTER (WHERE c_name IS NULL) AS failures FROM customer
    UNION ALL SELECT 'positive_balance', count(*) FILTER (WHERE NOT c_acctbal > 0) FROM customer
    UNION ALL SELECT 'known_nation', count(*) FILTER (WHERE c_nationkey = 3) FROM customer""")
def rule_failures(t):
    return quality.rule_failures(t.customer, RULES)


@query("dq_03_primary_key", "SELECT c_custkey, c_name FROM customer")
def primary_key(t):
    return quality.require_primary_key(t.customer, ["c_custkey"]).select("c_custkey", "c_name")


def balance_checks():
    return [
        (F.col("c_acctbal").isNull(), "NoBalance"),
        (F.col("c_acctbal") < 0, "NegativeBalance"),
        (F.col("c_nationkey") == 3, "ClosedNation"),
    ]


ERROR_SQL = "CASE WHEN c_acctbal < 0 THEN 'NegativeBalance' WHEN c_nationkey = 3 THEN 'ClosedNation' END"


@query("dq_04_quarantine", f"""
    SELECT CAST(c_custkey AS VARCHAR) AS id, {ERROR_SQL} AS error FROM customer""")
def quarantine(t):
    good, bad = quality.quarantine(t.customer, "c_custkey", balance_checks())
    kept = good.select(F.col("c_custkey").cast("string").alias("id"), F.lit(None).cast("string").alias("error"))
    return kept.unionByName(bad)


@query("dq_05_reconcile", """
    SELECT count(*) AS source_rows, count(*) FILTER (WHERE c_acctbal >= 0) AS target_rows,
           count(*) - count(*) FILTER (WHERE c_acctbal >= 0) AS missing FROM customer""")
def reconcile(t):
    path = t.scratch("loaded")
    writers.overwrite_parquet(t.customer.filter("c_acctbal >= 0"), path)
    return quality.reconcile(t.customer, t.spark.read.parquet(path))


@query("dq_06_run_report", f"""
    WITH e AS (SELECT {ERROR_SQL} AS error FROM customer)
    SELECT count(*) AS total_ids, count(*) FILTER (WHERE error IS NULL) AS succeeded,
           count(error) AS failed, count(DISTINCT error) AS reasons FROM e""")
def run_report(t):
    return quality.run_report(quality.with_error(t.customer, balance_checks()))


@query("dq_07_retry_set", f"""
    SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_nationkey = 3 THEN 'Timeout' ELSE {ERROR_SQL} END AS error
    FROM customer WHERE {ERROR_SQL} IS NOT NULL""")
def retry_set(t):
    good, bad = quality.quarantine(t.customer, "c_custkey", balance_checks(), store=False)
    ids = t.customer.select(F.col("c_custkey").cast("string").alias("id"))
    second = t.customer.filter("c_nationkey = 3").select(
        F.col("c_custkey").cast("string").alias("id"), F.lit("Timeout").alias("error"), F.lit(2).alias("attempt")
    )
    errors = bad.withColumn("attempt", F.lit(1)).unionByName(second)
    loaded = good.select(F.col("c_custkey").cast("string").alias("id"))
    return quality.retry_set(ids, loaded, errors, "attempt")


@query("dq_07_retry_table", f"""
    SELECT c_custkey AS id, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS DOUBLE) AS price
    FROM customer WHERE {ERROR_SQL} IS NOT NULL""")
def retry_table(t):
    """Failed ids appended to a stored table of the loaded shape."""
    shape = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("price"))
    path = t.scratch("retries")
    writers.append_parquet(quality.retry_rows(retry_set(t), shape), path)
    return t.spark.read.parquet(path)
