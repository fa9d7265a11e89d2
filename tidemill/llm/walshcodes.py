"""Product codes of vectors by an integer Walsh-Hadamard search.

A part of a vector and the entries of its codebook, padded with zeros to a power of two, are
transformed by additions and subtractions only. The transform of ``s`` places multiplies squared
distances by ``s``, so sums over its coefficients, in the order of their sequency, are lower bounds
that end in the exact scaled distance. An entry whose sum passes the full distance of another one is
out at once. All numbers are integers.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.frames import fields
from tidemill.llm.vectors import integers, matrix, partial_rows, partial_schema, summed
from tidemill.session import stored

TILE = 128  # rows compared with a codebook at once


@dataclass(frozen=True)
class Coded:
    """``rows``: the id and label columns, ``code`` (array of entry numbers) and ``error`` (squared distance).

    ``codebooks`` is an array of parts, entries and places.
    """

    rows: DataFrame
    codebooks: np.ndarray


def _added(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform over the last axis, a power of two, in natural order."""
    size, step = x.shape[-1], 1
    while step < size:
        pairs = x.reshape(*x.shape[:-1], size // (2 * step), 2, step)
        x = np.stack([pairs[..., 0, :] + pairs[..., 1, :], pairs[..., 0, :] - pairs[..., 1, :]], axis=-2)
        x = x.reshape(*x.shape[:-3], size)
        step *= 2
    return x


@lru_cache
def sequency(size: int) -> np.ndarray:
    """The rows of the transform by how often they change sign."""
    return np.argsort((np.diff(_added(np.eye(size, dtype=np.int64)), axis=-1) != 0).sum(axis=-1), kind="stable")


def walsh(x: np.ndarray) -> np.ndarray:
    """Integer coefficients of the zero-padded last axis by ascending sequency."""
    size = 1 << max(x.shape[-1] - 1, 0).bit_length()
    padded = np.zeros((*x.shape[:-1], size), dtype=np.int64)
    padded[..., : x.shape[-1]] = x
    return _added(padded)[..., sequency(size)]


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of every part and its squared distance, from coefficients; ties go to the lower number."""
    found = [_nearest(parts[a : a + TILE], entries) for a in range(0, len(parts), TILE)]
    nothing = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([nothing] + [f[i] for f in found]) for i in range(2))


def _nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = parts.shape[1]
    place, step = max(size // 2, 1), max(size // 8, 1)
    sums = np.zeros((len(parts), len(entries)), dtype=np.int64)
    for i in range(place):
        gap = parts[:, i, None] - entries[None, :, i]
        gap *= gap
        sums += gap
    row = np.arange(len(parts))
    bound = _full(parts, entries[sums.argmin(axis=1)])
    alive = sums <= bound[:, None]
    row, entry = np.nonzero(alive)
    sums = sums[alive]
    while place < size:
        for i in range(place, min(place + step, size)):
            gap = parts[row, i] - entries[entry, i]
            sums += gap * gap
        place += step
        first = _first_least(row, sums)
        bound = np.minimum(bound, _full(parts, entries[entry[first]]))
        alive = sums <= bound[row]
        row, entry, sums = row[alive], entry[alive], sums[alive]
    first = _first_least(row, sums)
    return entry[first], sums[first] // size


def _full(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    gap = parts - entries
    return (gap * gap).sum(axis=1)


def _first_least(row: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """For each row, of which every one is there, the place of its first least sum."""
    starts = np.searchsorted(row, np.arange(row[-1] + 1))
    hits = np.flatnonzero(sums == np.minimum.reduceat(sums, starts)[row])
    return hits[np.searchsorted(row[hits], np.arange(row[-1] + 1))]


def coded(
    embeddings: DataFrame, key: str = "vec_id", vector: str = "embedding", keep: tuple[str, ...] = ("label",), *,
    scale: int = 1024, parts: int = 4, entries: int = 256, rounds: int = 4,
) -> Coded:
    """Codes of all vectors, by codebooks learned from all of them.

    Components are ``floor(scale * x)``. The first ``entries`` vectors by key start the codebooks;
    each of ``rounds`` rounds moves every entry to the floored mean of its parts, and entries without
    parts stay. Null keys come last; of vectors that share a key the one with the smaller components
    comes first, and each of them is coded. Fewer vectors than entries make smaller codebooks. Vectors
    that are null or hold a null or non-finite component are dropped. All others should be as long as that
    of the first key; one of another length has no code and no error. A length that ``parts`` does not divide counts
    as padded with zeros. Without vectors there are no rows and no codebooks.
    """
    own = list(dict.fromkeys([key, *keep]))
    renamed = {c: f"_own_{i}" for i, c in enumerate(own)}
    rows = integers(embeddings, vector, scale, *[F.col(c).alias(n) for c, n in renamed.items()])
    rows = stored(rows, "integer_vectors")
    order = [F.col("_own_0").asc_nulls_last(), F.col("x").asc()]
    kinds = fields(rows, ("code", T.ArrayType(T.IntegerType())), ("error", T.LongType()), keep=list(renamed.values()))
    first = rows.orderBy(*order).select("x").first()
    if first is None:
        empty = rows.sparkSession.createDataFrame([], kinds)
        return Coded(empty.withColumnsRenamed({n: c for c, n in renamed.items()}), np.zeros((parts, 0, 0), dtype=np.int64))
    length = len(first.x)
    width = max(-(-length // parts), 1)
    fitting = rows.filter(F.size("x") == length)
    seeds = [r.x for r in fitting.orderBy(*order).limit(entries).select("x").collect()]
    books = _cut(np.array(seeds, dtype=np.int64).reshape(len(seeds), length), parts, width).swapaxes(0, 1)
    for _ in range(rounds):
        books = _moved(fitting, books)
    done = fitting.mapInArrow(_coder(books, list(renamed.values())), kinds)
    others = rows.filter(F.size("x") != length).select(
        *renamed.values(), F.lit(None).cast("array<int>").alias("code"), F.lit(None).cast("long").alias("error")
    )
    done = stored(done.unionByName(others), "vector_codes")
    return Coded(done.select(*[F.col(n).alias(c) for c, n in renamed.items()], "code", "error"), books)


def _cut(x: np.ndarray, parts: int, width: int) -> np.ndarray:
    """Vectors as rows, parts and places."""
    padded = np.zeros((len(x), parts * width), dtype=np.int64)
    padded[:, : x.shape[1]] = x
    return padded.reshape(len(x), parts, width)


def _moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every entry becomes the floored mean of the parts it is nearest to.

    Tasks send one row of sums per entry, and the driver gets one per entry.
    """
    parts, entries, width = books.shape
    told = rows.sparkSession.sparkContext.broadcast((books, walsh(books)))

    def learn(batches):
        books, coefficients = told.value
        n, sums = np.zeros((parts, entries), dtype=np.int64), np.zeros((parts, entries, width), dtype=np.int64)
        for batch in batches:
            x = _cut(matrix(batch.column("x")), parts, width)
            for part in range(parts):
                at, _ = nearest(walsh(x[:, part]), coefficients[part])
                np.add.at(sums[part], at, x[:, part])
                n[part] += np.bincount(at, minlength=entries)
        part, entry = np.nonzero(n)
        yield partial_rows({"part": part, "entry": entry}, n[part, entry], sums[part, entry])

    found = summed(rows.select("x").mapInArrow(learn, partial_schema(["part", "entry"], width)), ["part", "entry"], width)
    told.unpersist()
    moved = books.copy()
    for (part, entry), (n, sums) in found.items():
        moved[part, entry] = [s // n for s in sums]
    return moved


def _coder(books: np.ndarray, names: list[str]):
    parts, _, width = books.shape

    def code(batches):
        coefficients = walsh(books)
        for batch in batches:
            x = _cut(matrix(batch.column("x")), parts, width)
            found = [nearest(walsh(x[:, part]), coefficients[part]) for part in range(parts)]
            numbers = np.stack([f[0] for f in found], axis=1).astype(np.int32)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * parts)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.ListArray.from_arrays(offsets, pa.array(numbers.ravel())),
                 pa.array(sum(f[1] for f in found))], names=[*names, "code", "error"],
            )

    return code


def decimals(numbers: np.ndarray) -> str:
    """All numbers in order, as decimals joined by commas."""
    return ",".join(map(str, numbers.ravel().tolist()))


def _sql(rounds: int = 4, parts: int = 4, entries: int = 256, scale: int = 1024) -> str:
    """The contract's question in plain SQL, its rounds written out."""
    steps = [f"""
    kept AS MATERIALIZED (
        SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pieces AS MATERIALIZED (
        SELECT vec_id, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS p
        FROM kept CROSS JOIN (SELECT unnest(range({parts})) AS part)),
    book0 AS MATERIALIZED (
        SELECT part, entry, p AS q FROM (
            SELECT part, p, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM pieces)
        WHERE entry < {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
    near{i} AS MATERIALIZED (
        SELECT vec_id, part, any_value(p) AS p, min(CAST(list_sum(list_transform(list_zip(p, q),
            lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) * {entries} + entry) AS best
        FROM pieces JOIN book{i} USING (part) GROUP BY vec_id, part)""")
        if i < rounds:
            steps.append(f"""
    sums{i} AS (
        SELECT part, entry, place, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
            SELECT part, best % {entries} AS entry, unnest(p) AS x, unnest(range(len(p))) AS place FROM near{i})
        GROUP BY ALL),
    moved{i} AS (
        SELECT part, entry, list((s - (s % n + n) % n) // n ORDER BY place) AS m FROM sums{i} GROUP BY ALL),
    book{i + 1} AS MATERIALIZED (
        SELECT part, entry, coalesce(m, q) AS q FROM book{i} LEFT JOIN moved{i} USING (part, entry))""")
    return "WITH" + ",".join(steps) + f""",
    digest AS (
        SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}),
    codes AS (
        SELECT vec_id, string_agg(printf('%02x', best % {entries}), '' ORDER BY part) AS code,
               CAST(sum(best // {entries}) AS BIGINT) AS error
        FROM near{rounds} GROUP BY vec_id)
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM codes JOIN kept USING (vec_id) CROSS JOIN digest"""


SQL = _sql()
