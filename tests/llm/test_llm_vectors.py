"""Vector codes and bit-plane clusters against direct integer calculations."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tidemill.llm import planeclusters, walshcodes
from tidemill.llm.queries import REGISTRY

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
    T.StructField("label", T.IntegerType()), T.StructField("code", T.StringType()), T.StructField("x", T.StringType()),
    T.StructField("cluster", T.StringType()), T.StructField("_own", T.StringType()),
])


def vectors(dims=64, n=90, seed=3):
    """Clustered vectors with nulls, non-finite components, copies, ties, null and repeated ids."""
    r = random.Random(seed)
    centres = [[r.gauss(0, 0.2) for _ in range(dims)] for _ in range(5)]
    rows = [(i, [c + r.gauss(0, 0.05) for c in centres[i % 5]], r.choice([None, 0, 1])) for i in range(n)]
    copy = rows[7][1]
    third = [(1000 + i, copy, 2) for i in range(n // 2)]
    odd = [(500, None, 1), (501, [*copy[:-1], None], 1), (502, [*copy[:-1], math.nan], 1), (503, [math.inf, *copy[1:]], 1)]
    own = [(None, rows[3][1], None), (7, rows[9][1], 1), rows[8], (600, [0.0] * dims, 1), (601, [-0.0] * dims, None)]
    return [(*row, "a", "b", "c", "d") for row in [*rows, *third, *odd, *own]]


def scaled(rows, scale):
    out = []
    for key, v, label, *_ in rows:
        v = v and [None if x is None else float(np.float32(x)) for x in v]
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            out.append((key, [math.floor(scale * x) for x in v], label))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def squared(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b))


def near(v, entries):
    return min((squared(v, e), i) for i, e in enumerate(entries))[::-1]


def means(parts, entries):
    groups = {}
    for p in parts:
        groups.setdefault(near(p, entries)[0], []).append(p)
    return [[sum(c) // len(c) for c in zip(*groups[i])] if i in groups else e for i, e in enumerate(entries)]


def direct_codes(rows, parts, entries, rounds, scale=1024):
    kept = scaled(rows, scale)
    width = -(-len(kept[0][1]) // parts)
    cut = lambda v, i: (v + [0] * (width * parts - len(v)))[i * width : (i + 1) * width]
    books = []
    for i in range(parts):
        book = [cut(v, i) for _, v, _ in kept[:entries]]
        for _ in range(rounds):
            book = means([cut(v, i) for _, v, _ in kept], book)
        books.append(book)
    found = [(key, label, [near(cut(v, i), books[i]) for i in range(parts)]) for key, v, label in kept]
    return [(key, label, [n for n, _ in f], sum(d for _, d in f)) for key, label, f in found], books


def by_text(rows):
    return sorted(map(repr, rows))


@pytest.mark.parametrize("dims, parts, entries", [(64, 4, 16), (12, 4, 7), (10, 4, 200), (5, 1, 3)])
def test_codes_are_those_of_a_direct_search(spark, documents, dims, parts, entries):
    rows = vectors(dims)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = walshcodes.coded(df, parts=parts, entries=entries, rounds=2)
    expected, books = direct_codes(rows, parts, entries, 2)
    assert found.codebooks.tolist() == books
    assert by_text((r.vec_id, r.label, r.code, r.error) for r in found.rows.collect()) == by_text(expected)
    assert found.rows.columns == ["vec_id", "label", "code", "error"]


def test_transform_is_integer_orthogonal_and_by_sequency():
    for size in (1, 2, 8, 16):
        h = walshcodes.walsh(np.eye(size, dtype=np.int64))
        assert h.dtype == np.int64 and (h @ h.T == size * np.eye(size)).all()
        assert [int((np.diff(column) != 0).sum()) for column in h.T] == list(range(size))


def test_search_is_exact_on_ties_and_wide_numbers():
    r = np.random.default_rng(5)
    for width, top in ((16, 3), (16, 1 << 24), (3, 2), (1, 4)):
        parts, entries = r.integers(-top, top + 1, (300, width)), r.integers(-top, top + 1, (40, width))
        entries[20:] = entries[:20]
        at, distance = walshcodes.nearest(walshcodes.walsh(parts), walshcodes.walsh(entries))
        direct = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
        assert at.tolist() == direct.argmin(axis=1).tolist() and distance.tolist() == direct.min(axis=1).tolist()


def test_vectors_of_other_lengths_have_no_code(spark, documents):
    rows = [(2, [0.5] * 8, 1), (1, [0.25] * 8, 1), (3, [0.5] * 4, None), (4, [], 1)]
    df = spark.createDataFrame([(*r, None, None, None, None) for r in rows], SCHEMA)
    found = {r.vec_id: (r.code, r.error) for r in walshcodes.coded(df, entries=2, rounds=1).rows.collect()}
    assert found == {1: ([0] * 4, 0), 2: ([1] * 4, 0), 3: (None, None), 4: (None, None)}


def test_components_out_of_range_fail(spark, documents):
    df = spark.createDataFrame([(1, [1e6] * 4, 1, None, None, None, None)], SCHEMA)
    with pytest.raises(Exception, match="is not within"):
        walshcodes.coded(df)


def test_empty_tables_have_no_codes_and_no_clusters(spark, documents):
    for rows in ([], [(1, None, None, None, None, None, None)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert walshcodes.coded(df).rows.collect() == [] and planeclusters.clustered(df).rows.collect() == []


def direct_clusters(rows, centroids, rounds, scale=64):
    kept = [r for r in scaled(rows, scale) if len(r[1]) == 64]
    digest = lambda key: hashlib.sha256(f"1:{key}".encode()).hexdigest()
    ordered = sorted(kept, key=lambda r: (r[0] is None, digest(r[0]), r[1]))
    centres = [v for _, v, _ in ordered[:centroids]]
    for _ in range(rounds):
        centres = means([v for _, v, _ in kept], centres)
    return [(key, *near(v, centres)) for key, v, _ in kept], centres


@pytest.mark.parametrize("centroids, scale", [(16, 64), (3, 1), (400, 64), (5, 1 << 20)])
def test_clusters_are_those_of_a_direct_search(spark, documents, centroids, scale):
    rows = vectors() + [(*r[:3], None, None, None, None) for r in vectors(63, 10)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = planeclusters.clustered(df, centroids=centroids, rounds=2, scale=scale)
    expected, centres = direct_clusters(rows, centroids, 2, scale)
    assert found.centroids.tolist() == centres
    placed = [(r.vec_id, r.cluster, r.distance) for r in found.rows.collect()]
    assert by_text(placed) == by_text(expected)
    assert found.inertia == {c: sum(d for _, k, d in placed if k == c) for c in {k for _, k, _ in placed}}


def test_planes_hold_every_integer():
    r = np.random.default_rng(6)
    for top in (0, 1, 40, 1 << 24):
        x = r.integers(-top, top + 1, (50, 64))
        planes = planeclusters.packed(x)
        assert ((planeclusters.spread(planes) * planeclusters.weights(planes.shape[1])[None, :, None]).sum(axis=1) == x).all()
        y = r.integers(-7, 8, (9, 64))
        assert (planeclusters.dots(planes, planeclusters.packed(y)) == x @ y.T).all()
        assert (planeclusters.squares(planes) == (x * x).sum(axis=1)).all()


@pytest.mark.parametrize("name", ["op11_walsh_vector_codes", "op12_bit_plane_clusters"])
def test_queries_equal_their_sql(spark, documents, tmp_path, name):
    rows = [r for r in vectors() if r[0] is not None][:-4] + [(600, [0.0] * 64, 1, *"abcd")]
    rows = list({r[0]: r for r in rows}.values())
    spark.createDataFrame(rows, SCHEMA).drop("code", "x", "cluster", "_own").write.parquet(f"{tmp_path}/embeddings.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    expected = db.execute(REGISTRY[name].sql)
    names = [c[0] for c in expected.description]
    found = REGISTRY[name](spark, str(tmp_path)).select(*[F.col(c) for c in names]).collect()
    assert by_text(map(tuple, found)) == by_text(expected.fetchall())
