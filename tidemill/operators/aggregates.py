"""Counts, extremes, profiles and dashboards' figures.

Every aggregate here combines on the map side, so a hot key reaches the shuffle as one row
per task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window


def value_counts(df: DataFrame, value: Column, name: str, count: str = "n") -> DataFrame:
    """Frequency of each value, nulls left out, most frequent first."""
    counted = df.select(value.alias(name)).filter(F.col(name).isNotNull())
    return counted.groupBy(name).agg(F.count("*").alias(count)).orderBy(F.desc(count), name)


def item_counts(df: DataFrame, items: Column, name: str, count: str = "n") -> DataFrame:
    """Frequency of each item of a list column, blanks left out."""
    exploded = df.select(F.explode(items).alias(name))
    return value_counts(exploded.filter(F.trim(name) != ""), F.col(name), name, count)


def extreme_rows(df: DataFrame, measure: str, largest: bool = True) -> DataFrame:
    """Every row that holds the largest (or smallest) value, ties included.

    The value is found by a scan of its column alone; ties, however many, stay where they are.
    """
    pick = F.max if largest else F.min
    return df.filter(F.col(measure) == df.select(pick(measure)).scalar())


def maximum(df: DataFrame, column: str, default: Column) -> Column:
    """The largest value as a scalar, or the default for an empty table."""
    return df.select(F.coalesce(F.max(column), default)).scalar()


def column_profile(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Count, mean, deviation, least and greatest value, one row per column."""
    one = F.array(*[
        F.struct(
            F.lit(n).alias("column"),
            F.count(n).alias("filled"),
            F.avg(n).alias("mean"),
            F.stddev(n).alias("deviation"),
            F.min(F.col(n).cast("double")).alias("least"),
            F.max(F.col(n).cast("double")).alias("greatest"),
        )
        for n in names
    ])
    return df.agg(one.alias("profile")).select(F.inline("profile"))


def exact_quantiles(
    df: DataFrame, names: Sequence[str], shares: Sequence[float], held: int = 100_000, accuracy: int = 10_000
) -> DataFrame:
    """``column, share, value``: exact quantiles of numeric columns, interpolated between neighbours.

    No column is sorted. A mergeable sketch proposes two values around a wanted rank, and counting the rows
    below and at each of them tells exactly on which side, or between them, the rank lies. Every round
    narrows the open interval about by ``accuracy``; once it holds at most ``held`` rows, these are looked at.
    Nulls are left out; a column without values has null quantiles.
    """
    values = df.select(*[F.col(n).cast("double").alias(n) for n in names])
    filled = values.agg(*[F.count(n).alias(n) for n in names]).first()
    places = {(n, s): s * (filled[n] - 1) for n in names for s in shares if filled[n]}
    # Rank by rank: the open interval its value is in, the rows not above the interval's start, the rows in it.
    waiting = {(n, r): (None, None, 0, filled[n]) for (n, _), p in places.items() for r in {math.floor(p), math.ceil(p)}}
    known: dict[tuple[str, int], float] = {}

    def within(name: str, lo: float | None, hi: float | None) -> Column:
        value, test = F.col(name), F.col(name).isNotNull()
        test = test if lo is None else test & (value > lo)
        return F.when(test if hi is None else test & (value < hi), value)

    while waiting:
        sketched = []
        for (name, rank), (lo, hi, below, inside) in waiting.items():
            near = (rank - below + 0.5) / inside
            margin = [max(near - 2 / accuracy, 0.0), min(near + 2 / accuracy, 1.0)]
            sketched.append(
                F.array(F.get(F.sort_array(F.collect_list(within(name, lo, hi))), F.lit(rank - below))) if inside <= held
                else F.percentile_approx(within(name, lo, hi), margin, accuracy)
            )
        found = values.agg(F.array(*sketched)).first()[0]
        bounds = {}
        for key, values_found in zip(list(waiting), found):
            if len(values_found) == 1:
                known[key] = values_found[0]
                del waiting[key]
            else:
                bounds[key] = values_found
        if bounds:
            counts = values.agg(F.array(*[
                F.array(*[F.count_if(test) for c in pair for test in (F.col(name) < c, F.col(name) <= c)]) for (name, _), pair in bounds.items()
            ])).first()[0]
            for (key, (a, b)), (under_a, to_a, under_b, to_b) in zip(bounds.items(), counts):
                (lo, hi, below, inside), rank = waiting.pop(key), key[1]
                if under_a <= rank < to_a or under_b <= rank < to_b:
                    known[key] = a if rank < to_a else b
                elif rank < under_a:
                    waiting[key] = lo, a, below, under_a - below
                elif rank < under_b:
                    waiting[key] = a, b, to_a, under_b - to_a
                else:
                    waiting[key] = b, hi, to_b, below + inside - to_b
    rows = []
    for name in names:
        for share in shares:
            place = places.get((name, share))
            if place is not None:
                least, most = known[name, math.floor(place)], known[name, math.ceil(place)]
                place = least if least == most else least + (most - least) * (place - math.floor(place))
            rows.append((name, float(share), place))
    return df.sparkSession.createDataFrame(rows, "column STRING, share DOUBLE, value DOUBLE")


def with_share(counted: DataFrame, measure: str, name: str) -> DataFrame:
    """Add each row's share of the total of an aggregated frame."""
    return counted.withColumn(name, F.col(measure) / counted.select(F.sum(measure)).scalar())


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank"
) -> DataFrame:
    """The first ``n`` rows of each group; every map task forwards at most ``n`` per group."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def top_groups(df: DataFrame, by: str, measure: Column, name: str, n: int, buckets: int = 1 << 16, first: int = 64) -> DataFrame:
    """The ``n`` groups with the largest sums of a measure that is never negative, ties by the smaller key.

    Only groups that can be among them are shuffled. Sums of hash buckets bound their groups from above and
    are few; the exact sums of the groups in the ``first`` largest buckets give the n-th best one so far, and
    buckets below it hold no group to report. Null keys are a group; a negative measure fails the job.
    """
    negative = F.raise_error(F.lit(f"{name} sums a negative value"))
    rows = df.select(F.col(by), F.when(measure < 0, negative).otherwise(measure).alias("_measure"))
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(by), F.lit(buckets)))
    # One row per bucket: at most ``buckets`` numbers reach the driver.
    sums = rows.groupBy("_bucket").agg(F.sum("_measure").alias("total")).orderBy(F.desc("total")).collect()
    exact = lambda of: rows.filter(F.col("_bucket").isin(of)).groupBy(by).agg(F.sum("_measure").alias(name))
    order = [F.desc(name), F.asc_nulls_first(by)]
    largest = [r["_bucket"] for r in sums[:first]]
    best = exact(largest).orderBy(*order).limit(n).collect()
    least = best[-1][name] if len(best) == n else None
    # A sum of doubles depends a little on its order, so a bucket just below the bound is counted too.
    able = [r["_bucket"] for r in sums if least is None or r["total"] is None or r["total"] >= least - abs(least) * 1e-9]
    return exact(able).orderBy(*order).limit(n)


def flow_matrix(
    df: DataFrame, origin: str, target: str, targets: Sequence[str], other: str = "other"
) -> DataFrame:
    """Origins as rows, the listed targets as columns, row counts in the cells; all further
    targets, and missing ones, are counted as ``other``."""
    known = F.when(F.col(target).isin(list(targets)), F.col(target)).otherwise(other)
    counts = df.withColumn(target, known).groupBy(origin).pivot(target, [*targets, other]).count()
    return counts.na.fill(0)
