"""Exact quantiles against sorting, with sketches far too coarse for the answer."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tidemill.operators import aggregates

SHARES = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


def columns(n):
    r = random.Random(n)
    return {
        "wide": [r.gauss(0, 1e6) for _ in range(n)],
        "third": [5.0 if r.random() < 1 / 3 else r.random() * 10 for _ in range(n)],
        "one": [7.0] * n,
        "holes": [None if r.random() < 0.5 else float(r.randrange(4)) for _ in range(n)],
        "steep": [10.0 ** r.randrange(-5, 12) for _ in range(n)],
        "none": [None] * n,
    }


@pytest.mark.parametrize("n, held, accuracy", [(3000, 20, 10), (3000, 1, 50), (3000, 100_000, 10_000), (1, 1, 10), (2, 1, 10), (0, 10, 10)])
def test_quantiles_equal_those_of_sorted_columns(spark, n, held, accuracy):
    data = columns(n)
    df = spark.createDataFrame(list(zip(range(n), *data.values())), "id LONG, " + ", ".join(f"{c} DOUBLE" for c in data)).repartition(3)
    found = {(r["column"], r.share): r.value for r in aggregates.exact_quantiles(df, list(data), SHARES, held, accuracy).collect()}
    for name, values in data.items():
        filled = [v for v in values if v is not None]
        for share in SHARES:
            if filled:
                assert found[name, share] == pytest.approx(np.quantile(filled, share), rel=1e-12)
            else:
                assert found[name, share] is None


def best(rows, n):
    sums = {}
    for key, value in rows:
        sums[key] = sums.get(key, 0) + (value or 0)
    return sorted(sums.items(), key=lambda kv: (-kv[1], kv[0] is not None, kv[0] or ""))[:n]


@pytest.mark.parametrize("buckets, first", [(1 << 16, 64), (256, 2), (1, 1), (16, 16)])
@pytest.mark.parametrize("n", [1, 10, 5000])
def test_top_groups_equal_those_of_all(spark, buckets, first, n):
    """One key with a third of all rows, ties at the cut, a null key, more groups than buckets."""
    r = random.Random(9)
    rows = [(None if i % 50 == 0 else "hot" if i % 3 == 0 else f"k{int(r.paretovariate(0.6)) % 1500}", r.randrange(3)) for i in range(6000)]
    df = spark.createDataFrame(rows, "k STRING, v LONG").repartition(4)
    found = aggregates.top_groups(df, "k", F.col("v"), "total", n, buckets, first)
    assert [(x.k, x.total) for x in found.collect()] == best(rows, n)


def test_only_groups_that_can_win_are_shuffled(spark):
    """Of 20,000 groups few are added up: the plan of the answer reads their buckets only."""
    df = spark.range(100_000).selectExpr("IF(id % 3 = 0, -(id % 9), id % 20000) AS k", "1L AS v")
    found = aggregates.top_groups(df, "k", F.col("v"), "total", 3)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    (tested,) = re.findall(r"_bucket#\d+L? (?:IN|INSET) \(?([^)]*)", text) or re.findall(r" IN \(([^)]*)\)", text) or [text]
    assert tested.count(",") < 100
    assert [x.k for x in found.collect()] == [0, -6, -3]


def test_negative_measures_fail(spark):
    with pytest.raises(Exception, match="negative"):
        aggregates.top_groups(spark.range(5), "id", F.col("id") - 2, "total", 2)
