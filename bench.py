"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from tidemill.operators import ordered
from tidemill.plans import REGISTRY
from tidemill.session import build_session

HEADLINES = [
    "jn_01_left_join", "jn_02_star_fact", "jn_03_key_lookup", "jn_06_role_playing", "jn_07_feed_correlation",
    "agg_02_last_per_group", "agg_06_extreme_rows_with_ties", "agg_09_item_counts", "agg_11_product_year",
    "agg_12_monthly_figures", "agg_14_revenue_by_place", "agg_15_flow_matrix", "agg_16_column_profile",
    "win_01_dense_rank", "win_03_row_number", "win_04_dense_keys", "win_07_odometer", "srt_01_sorted_by_date",
    "srt_02_top_profit", "srt_06_top_groups", "set_02_keep_first", "dml_01_fact_upsert", "dml_02_scd1",
    "dml_03_scd2", "dml_06_update", "dml_12_latest_version", "dq_01_column_tests", "dq_07_retry_set",
    "str_08_html_to_text", "str_09_first_sentences", "str_10_shorten", "str_11_drop_sentences", "udf_04_describe_pages", "jsn_04_product_record",
    "src_07_topic_stream", "stm_06_stream_join",
]


# Text cleaning is measured in rows a second too.
CLEANING = {
    "str_08_html_to_text": "pages", "str_09_first_sentences": "documents", "str_10_shorten": "documents",
    "str_11_drop_sentences": "documents", "udf_04_describe_pages": "pages", "jsn_04_product_record": "pages",
}


def skewed(spark, folder: str):
    """Line items of which one supplier has a third."""
    supplier = F.when(F.col("l_linenumber") <= 2, 0).otherwise(F.col("l_suppkey"))
    items = spark.read.parquet(f"{folder}/lineitem.parquet")
    return items.select(supplier.alias("supplier"), "l_extendedprice", "l_orderkey", "l_linenumber")


SKEWED = {
    "skewed_win_01": lambda df: ordered.ranked(df, ["supplier"], "l_extendedprice", descending=True, dense_rank="place"),
    "skewed_win_04": lambda df: ordered.dense_keys(df, "supplier", "key"),
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["agg_07_row_count"](spark, folder).collect()  # start-up is not part of any query
    seconds = {}
    for name in HEADLINES:
        started = time.perf_counter()
        REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    extra = {}
    for name, job in SKEWED.items():
        started = time.perf_counter()
        job(skewed(spark, folder)).write.format("noop").mode("overwrite").save()
        extra[name] = round(time.perf_counter() - started, 3)
    rates = {
        name: round(spark.read.parquet(f"{folder}/{table}.parquet").count() / seconds[name])
        for name, table in CLEANING.items()
    }
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "skewed": extra,
        "rows_per_second": rates,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
