"""Joins between facts, dimensions and feeds.

No side is broadcast by hand: Spark broadcasts a side whose measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise sorts and merges, splitting hot keys
at run time (see ``session.RUNTIME_SETTINGS``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same(left: str, right: str, pairs: Sequence[tuple[str, str]], null_safe: bool = False) -> Column:
    """Equality of the paired columns of two aliased frames."""
    tests = []
    for a, b in pairs:
        a, b = F.col(f"{left}.{a}"), F.col(f"{right}.{b}")
        tests.append(a.eqNullSafe(b) if null_safe else a == b)
    return reduce(lambda x, y: x & y, tests)


def keys_of(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The distinct keys: each map task sends a hot key once, however many rows hold it."""
    return df.select(*names).distinct()


def left_join_many(one: DataFrame, many: DataFrame, one_key: str, many_key: str) -> DataFrame:
    """``one LEFT JOIN many`` where one key of ``many`` may hold a large share of its rows.

    Spark cannot split the right side of a left join, so the matches come from an inner join
    (which it can split) and the rest from an anti join against the distinct keys.
    """
    matched = one.join(many, one[one_key] == many[many_key])
    stored = keys_of(many, [many_key]).withColumnRenamed(many_key, "_stored_key")
    unmatched = one.join(stored, F.col(one_key) == F.col("_stored_key"), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def new_rows(df: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet."""
    return df.join(keys_of(stored, keys), list(keys), "left_anti")


def existing_rows(df: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is stored already."""
    return df.join(keys_of(stored, keys), list(keys), "left_semi")


def lookup(fact: DataFrame, dimension: DataFrame, fact_key: str, natural_key: str, **adds: str) -> DataFrame:
    """Add dimension columns to a fact (``new_name="dimension_column"``); no match gives null."""
    picked = dimension.select(
        F.col(natural_key).alias("_natural"), *[F.col(c).alias(n) for n, c in adds.items()]
    )
    return fact.join(picked, F.col(fact_key) == F.col("_natural"), "left").drop("_natural")


def star_fact(items: DataFrame, goods: DataFrame, orders: DataFrame, users: DataFrame) -> DataFrame:
    """One row per order item, with its buyer, value and order date.

    Expects ``items(order_id, goods_id, order_item_id, quantity)``, ``goods(goods_id, price)``,
    ``orders(order_id, user_id, order_date)`` and ``users(user_id, user_name)``.
    """
    return (
        items.join(orders, "order_id")  # first, as both sides may be stored in buckets of it
        .join(goods, "goods_id")
        .join(users, "user_id")
        .withColumns({
            "number_of_items_ordered": F.col("quantity"),
            "total_purchase_value": F.col("quantity") * F.col("price"),
        })
    )


def correlate(left: DataFrame, right: DataFrame, device: str, moment: str) -> DataFrame:
    """Pair the readings two feeds took for one device at one moment.

    Feeds sent together carry the same device and time, never the same id. Each side must
    hold one row per device and moment, so nothing multiplies. Works on streams as well,
    where both sides need a watermark on ``moment``.
    """
    renamed = right.withColumnsRenamed({device: "_device", moment: "_moment"})
    condition = (F.col(device) == F.col("_device")) & (F.col(moment) == F.col("_moment"))
    return left.join(renamed, condition).drop("_device", "_moment")


def correlate_all(feeds: Mapping[str, DataFrame], device: str, moment: str) -> DataFrame:
    """The readings that all feeds took for one device at one moment, one after another joined.

    Columns of a feed but ``device`` and ``moment`` come as ``<feed>_<column>``. Each feed must hold
    one row per device and moment. On streams every feed needs a watermark on ``moment``: the joins
    are on the event time itself, so what no later reading can meet leaves the state of every join. Spark's
    default policy, the minimum, lets the slowest feed hold the watermark, so no feed loses rows to a faster one.
    """
    joined = None
    for name, feed in feeds.items():
        own = feed.select(device, moment, *[F.col(c).alias(f"{name}_{c}") for c in feed.columns if c not in (device, moment)])
        joined = own if joined is None else correlate(joined, own, device, moment)
    return joined


def correlate_within(left: DataFrame, right: DataFrame, device: str, moment: str, seconds: int) -> DataFrame:
    """Pair raw readings of one device that lie at most ``seconds`` apart.

    Times meet in buckets of that length, the right side in its own and both next to it, so a
    device with very many readings is many keys. Works on streams, where both sides need a
    watermark on ``moment``; the bound tells Spark when state can go.
    """
    bucket = lambda column: F.floor(F.unix_micros(F.col(column).cast("timestamp")) / (seconds * 1_000_000))
    near = F.array(*[bucket("_moment") + i for i in (-1, 0, 1)])
    renamed = right.withColumnsRenamed({device: "_device", moment: "_moment"}).withColumn("_bucket", F.explode(near))
    span = F.expr(f"interval {seconds} seconds")
    condition = (
        (F.col(device) == F.col("_device")) & (F.col("_own_bucket") == F.col("_bucket"))
        & (F.col(moment) >= F.col("_moment") - span) & (F.col(moment) <= F.col("_moment") + span)
    )
    return left.withColumn("_own_bucket", bucket(moment)).join(renamed, condition).drop(
        "_device", "_moment", "_bucket", "_own_bucket"
    )
