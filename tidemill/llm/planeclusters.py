"""Centroid clustering over bit planes.

A vector of 64 integers is kept as its bit planes in two's complement, each one 64-bit word. The dot
product of two vectors is the sum over pairs of planes of the product of their weights and the number
of bits set in both, so distances are exact integers made of AND and popcounts alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.frames import fields
from tidemill.llm.vectors import integers, matrix, partial_rows, partial_schema, summed
from tidemill.session import stored

DIMS = 64
TILE = 4096  # vectors compared with all centroids at once


@dataclass(frozen=True)
class Clustered:
    """``rows``: the id, ``cluster`` and ``distance`` (squared); ``centroids`` by number; ``inertia`` by cluster number."""

    rows: DataFrame
    centroids: np.ndarray
    inertia: dict[int, int]


def weights(planes: int) -> np.ndarray:
    """The value of each plane's bit; the last one is the sign."""
    values = np.int64(1) << np.arange(planes, dtype=np.int64)
    values[-1] *= -1
    return values


def packed(x: np.ndarray) -> np.ndarray:
    """The bit planes of integer vectors, as many as the largest component needs and one for the sign."""
    count = int(np.maximum(x, ~x).max(initial=0)).bit_length() + 1
    bits = (x[:, None, :] >> np.arange(count)[None, :, None] & 1).astype(np.uint8)
    return np.packbits(bits, axis=2, bitorder="little").view("<u8")[:, :, 0]


def spread(planes: np.ndarray) -> np.ndarray:
    """The bits of planes: rows, planes, components."""
    return np.unpackbits(np.ascontiguousarray(planes)[:, :, None].view(np.uint8), axis=2, bitorder="little")


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The dot product of every row of ``a`` with every row of ``b``, both as planes."""
    total = np.zeros((len(a), len(b)), dtype=np.int64)
    for i, v in enumerate(weights(a.shape[1])):
        for j, w in enumerate(weights(b.shape[1])):
            total += np.bitwise_count(a[:, i, None] & b[None, :, j]) * (v * w)
    return total


def squares(planes: np.ndarray) -> np.ndarray:
    """The squared length of every row."""
    total = np.zeros(len(planes), dtype=np.int64)
    for i, v in enumerate(weights(planes.shape[1])):
        for j, w in enumerate(weights(planes.shape[1])):
            total += np.bitwise_count(planes[:, i] & planes[:, j]) * (v * w)
    return total


def nearest(planes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of every vector and its squared distance; ties go to the smaller number."""
    found = []
    for a in range(0, len(planes), TILE):
        tile = planes[a : a + TILE]
        distance = squares(tile)[:, None] + squares(centroids)[None, :] - 2 * dots(tile, centroids)
        at = distance.argmin(axis=1)
        found.append((at, distance[np.arange(len(tile)), at]))
    nothing = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([nothing] + [f[i] for f in found]) for i in range(2))


def _planes(column: pa.Array) -> np.ndarray:
    """Stored planes; rows of fewer planes repeat their sign."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    starts = np.cumsum(sizes) - sizes
    take = np.minimum(np.arange(sizes.max(initial=1))[None, :], sizes[:, None] - 1)
    return flat[starts[:, None] + take]


def _lists(planes: np.ndarray) -> pa.Array:
    offsets = np.arange(len(planes) + 1, dtype=np.int32) * planes.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(planes).view(np.int64).ravel()))


def clustered(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", *, scale: int = 64, centroids: int = 16, rounds: int = 3, seed: int = 1,
) -> Clustered:
    """Clusters of all vectors of exactly 64 components, none of them null or non-finite; others are dropped.

    Components are ``floor(scale * x)``. The vectors whose key has the smallest SHA-256 of
    ``seed:key`` start the centroids; each of ``rounds`` rounds moves every centroid to the floored
    mean of its vectors, and one without vectors stays. Vectors without a key start none as long as others
    do; of vectors that share a key the one with the smaller components goes first, and each
    has a row. Fewer vectors than centroids make fewer clusters; without vectors there are no rows.
    """
    named = F.col(key).alias("_own")
    whole = integers(embeddings.filter(F.size(vector) == DIMS), vector, scale, named)
    kinds = fields(whole, ("planes", T.ArrayType(T.LongType())), keep=["_own"])

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                planes = packed(matrix(batch.column("x")))
                yield pa.RecordBatch.from_arrays([batch.column("_own"), _lists(planes)], names=["_own", "planes"])

    rows = stored(whole.mapInArrow(pack, kinds), "planes")
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_own").cast("string")), 256)
    drawn = whole.orderBy(rank.asc_nulls_last(), "x").limit(centroids).select("x").collect()
    seeds = np.array([r.x for r in drawn], dtype=np.int64).reshape(len(drawn), DIMS)
    kinds = fields(rows, ("cluster", T.IntegerType()), ("distance", T.LongType()), keep=["_own"])
    for _ in range(rounds):
        seeds = _moved(rows, seeds) if len(seeds) else seeds
    told = packed(seeds)

    def place(batches):
        for batch in batches:
            at, distance = nearest(_planes(batch.column("planes")), told)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_own"), pa.array(at.astype(np.int32)), pa.array(distance)], names=["_own", "cluster", "distance"]
            )

    done = stored(rows.mapInArrow(place, kinds), "clusters")
    sums = done.groupBy("cluster").agg(F.sum("distance").alias("distance")).collect()  # one row per centroid
    return Clustered(done.withColumnRenamed("_own", key), seeds, {r.cluster: r.distance for r in sums})


def _moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """One round: every centroid becomes the floored mean of its vectors, summed bit by bit."""
    told = packed(centroids)

    def learn(batches):
        n, sums = np.zeros(len(told), dtype=np.int64), np.zeros((len(told), DIMS), dtype=np.int64)
        for batch in batches:
            planes = _planes(batch.column("planes"))
            at, _ = nearest(planes, told)
            order = np.argsort(at, kind="stable")
            seen, starts = np.unique(at[order], return_index=True)
            if len(seen):
                bits = np.add.reduceat(spread(planes[order]), starts, axis=0, dtype=np.int64)
                sums[seen] += (bits * weights(planes.shape[1])[None, :, None]).sum(axis=1)
                n += np.bincount(at, minlength=len(told))
        own = np.flatnonzero(n)
        yield partial_rows({"cluster": own}, n[own], sums[own])

    found = summed(rows.select("planes").mapInArrow(learn, partial_schema(["cluster"], DIMS)), ["cluster"], DIMS)
    moved = centroids.copy()
    for (cluster,), (n, sums) in found.items():
        moved[cluster] = [s // n for s in sums]
    return moved


def _sql(rounds: int = 3, centroids: int = 16, scale: int = 64, seed: int = 1) -> str:
    """The contract's question in plain SQL, its rounds written out."""
    steps = [f"""
    kept AS MATERIALIZED (
        SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE len(embedding) = {DIMS}
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    centre0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS cluster, v AS q FROM kept
        QUALIFY cluster < {centroids})"""]
    for i in range(rounds + 1):
        steps.append(f"""
    near{i} AS MATERIALIZED (
        SELECT vec_id, any_value(v) AS v, min(CAST(list_sum(list_transform(list_zip(v, q),
            lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * {centroids} + cluster) AS best
        FROM kept CROSS JOIN centre{i} GROUP BY vec_id)""")
        if i < rounds:
            steps.append(f"""
    sums{i} AS (
        SELECT cluster, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
            SELECT best % {centroids} AS cluster, unnest(v) AS x, unnest(range({DIMS})) AS place FROM near{i})
        GROUP BY ALL),
    moved{i} AS (SELECT cluster, list((s - (s % n + n) % n) // n ORDER BY place) AS m FROM sums{i} GROUP BY ALL),
    centre{i + 1} AS MATERIALIZED (
        SELECT cluster, coalesce(m, q) AS q FROM centre{i} LEFT JOIN moved{i} USING (cluster))""")
    return "WITH" + ",".join(steps) + f""",
    placed AS (SELECT vec_id, CAST(best % {centroids} AS INTEGER) AS cluster, best // {centroids} AS distance FROM near{rounds})
    SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
           CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(q, ',')) AS centroid_sha256
    FROM placed JOIN centre{rounds} USING (cluster)"""


SQL = _sql()
