"""Numbers, dates and rules. Unreadable input becomes null; nothing here raises on bad data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(value: Column) -> Column:
    return value.try_cast("double")


def to_moment(text: Column, *formats: str) -> Column:
    """The first format that fits; without formats, any ISO date or timestamp."""
    if not formats:
        return F.try_to_timestamp(text)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def profit(revenue: Column, cost: Column, fill: float | None = 0.0) -> Column:
    """``revenue - cost``; missing sides count as ``fill``, or make the result null."""
    if fill is None:
        return revenue - cost
    return F.coalesce(revenue, F.lit(fill)) - F.coalesce(cost, F.lit(fill))


def discounted(price: Column, share: float = 0.90) -> Column:
    return price * F.lit(share)


def line_value(quantity: Column, price: Column) -> Column:
    return quantity * price


def age_in_years(born: Column, as_of: Column) -> Column:
    return F.floor(F.months_between(as_of, born) / 12).cast("int")


def delay_in_days(ordered: Column, delivered: Column) -> Column:
    return F.datediff(delivered, ordered)


def first_match(rules: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The label of the first rule that holds."""
    (condition, label), *rest = rules
    chosen = F.when(condition, F.lit(label))
    for condition, label in rest:
        chosen = chosen.when(condition, F.lit(label))
    return chosen.otherwise(F.lit(otherwise))
