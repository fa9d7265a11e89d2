"""Integer vectors from a float column, and exact sums of them per group."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1 << 25  # squared distances of vectors within it fit a long


def integers(embeddings: DataFrame, vector: str, scale: int, *keep: str) -> DataFrame:
    """``keep`` columns and ``x``: ``floor(scale * component)`` of every vector.

    Vectors that are null or hold a null, NaN or infinite component are dropped. A component
    beyond ``LIMIT`` fails the job, as sums of squares would not be exact.
    """
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    wide = F.raise_error(F.lit(f"a component is not within {LIMIT} once scaled by {scale}")).cast("int")

    def whole(v):
        scaled = F.floor(v.cast("double") * F.lit(float(scale)))
        return F.when(F.abs(scaled) < LIMIT, scaled.cast("int")).otherwise(wide)

    return embeddings.filter(finite).select(*keep, F.transform(vector, whole).alias("x"))


def matrix(column: pa.Array, kind=np.int64) -> np.ndarray:
    """Lists of one length as the rows of an array."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def summed(frame: DataFrame, by: Sequence[str], width: int) -> dict[tuple, tuple[int, list[int]]]:
    """Counts ``n`` and sums ``s0, s1, ...`` of partial rows, by group: for keys with few values, as all reach the driver."""
    sums = [F.sum(f"s{i}").alias(f"s{i}") for i in range(width)]
    rows = frame.groupBy(*by).agg(F.sum("n").alias("n"), *sums).collect()
    return {tuple(r[c] for c in by): (r["n"], [r[f"s{i}"] for i in range(width)]) for r in rows}


def partial_rows(keys: dict[str, np.ndarray], n: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """The partial counts and sums of a task's groups, for ``summed``."""
    columns = {**{k: pa.array(v.astype(np.int32)) for k, v in keys.items()}, "n": pa.array(n)}
    columns |= {f"s{i}": pa.array(np.ascontiguousarray(sums[:, i])) for i in range(sums.shape[1])}
    return pa.RecordBatch.from_pydict(columns)


def partial_schema(by: Sequence[str], width: int) -> str:
    return ", ".join([*[f"{k} int" for k in by], "n long", *[f"s{i} long" for i in range(width)]])
