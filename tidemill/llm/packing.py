"""Best-fit packing of token pieces into sequences under several capacities at once.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared
lengths, what block-diagonal attention pays). A piece's needs follow from its length alone, so
pieces of one length are interchangeable, and so are sequences with equal residuals. The plan
is made on the histogram of lengths, whose size is bounded by the longest piece; Spark counts
it, and hands every piece its place in the plan.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.columns import slices
from tidemill.llm.tokens import encoder, ids_crc32
from tidemill.session import stored

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacities:
    """What one sequence holds, and how much each dimension weighs when a sequence is chosen."""

    tokens: int = 4096
    documents: int = 4096
    attention: int = 4096 * 4096
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    rule: str = "norm"  # or "dot": weighted dot-product of need and residual

    def needs(self, length: int) -> np.ndarray:
        return np.array([length, 1, length * length], dtype=np.int64)

    @property
    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], dtype=np.int64)


def pieces_of(documents: DataFrame, path: str, end_id: int, most: int) -> DataFrame:
    """The token pieces of each document: its ids and ``end_id``, cut after every ``most`` ids.

    Only documents longer than ``most`` are cut. Null and empty texts give one piece with the
    end id alone; repeated rows give repeated pieces.
    """

    def cut(batches):
        enc = encoder(path)
        for batch in slices(batches, "text"):
            ids, bounds = enc.encode(batch.column("text"))
            rows = []
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                own = np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end_id))
                for number, start in enumerate(range(0, len(own), most)):
                    part = own[start : start + most]
                    rows.append((doc, number, start, len(part), ids_crc32(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECES)


def plan(histogram: dict[int, int], capacities: Capacities) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over a histogram of lengths.

    Lengths come longest first. Each goes to the open sequences that suit it best: those that
    it leaves with the smallest weighted residual norm, or whose residual has the largest
    weighted dot-product with its needs; every capacity must hold. Sequences with one residual
    form a class and are filled together, so the work depends on the number of distinct lengths
    and residuals, not of pieces. Rows: length, first piece (in the length's own numbering),
    pieces, pieces per sequence, first sequence, offset in the sequence.
    """
    limits = capacities.limits
    scale = np.array(capacities.weights, dtype=np.float64) / limits.astype(np.float64) ** 2
    residual = np.zeros((0, 3), dtype=np.int64)  # of each class of open sequences
    count = np.zeros(0, dtype=np.int64)
    first = np.zeros(0, dtype=np.int64)
    placements, sequences = [], 0

    def copies(room: np.ndarray, need: np.ndarray) -> int:
        return int((room // need).min())

    for length in sorted(histogram, reverse=True):
        left, need, done = histogram[length], capacities.needs(length), 0
        if copies(limits, need) < 1:
            raise ValueError(f"a piece of {length} tokens fits no sequence")
        while left:
            fits = np.flatnonzero((residual >= need).all(axis=1))
            if len(fits):
                rest = residual[fits]
                if capacities.rule == "dot":
                    score = -((rest * need) * scale).sum(axis=1)
                else:
                    score = ((rest - need).astype(np.float64) ** 2 * scale).sum(axis=1)
                chosen = fits[np.lexsort((first[fits], score))[0]]
                room, have, start = residual[chosen], int(count[chosen]), int(first[chosen])
                residual, count, first = (np.delete(a, chosen, axis=0) for a in (residual, count, first))
            else:
                room, start = limits, sequences
                have = -(-left // copies(limits, need))
                sequences += have
            each = copies(room, need)
            offset = int(limits[0] - room[0])
            full = min(have, left // each)
            parts = [(full, each)] if full else []
            if full < have and left > full * each:
                parts.append((1, left - full * each))
            used = 0
            for n, k in parts:
                placements.append((length, done, n * k, k, start + used, offset))
                done, left = done + n * k, left - n * k
                residual = np.vstack([residual, room - k * need])
                count, first = np.append(count, n), np.append(first, start + used)
                used += n
            if used < have:
                residual = np.vstack([residual, room])
                count, first = np.append(count, have - used), np.append(first, start + used)
            spent = residual[:, 0] > 0
            residual, count, first = residual[spent], count[spent], first[spent]
    return placements


def pack(pieces: DataFrame, capacities: Capacities, bucket_rows: int = 100_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length``.

    ``pieces`` must be stored, with a column ``_spread`` of evenly spread numbers, as it is read twice.
    Pieces are numbered within their length by buckets of about ``bucket_rows`` rows, so a length that
    most pieces share, or a row that is repeated many times, is many tasks' work. Only the histogram (at most one row per possible length) and the plan made of
    it pass through the driver. An empty table stays empty.
    """
    spark = pieces.sparkSession
    keys = [c for c in pieces.columns if c != "_spread"]
    counted = pieces.groupBy("length").count().collect()
    histogram = {r["length"]: r["count"] for r in counted}
    placements = plan(histogram, capacities)
    buckets = sum(histogram.values()) // bucket_rows + 1
    bucketed = pieces.withColumn("_bucket", F.pmod("_spread", F.lit(buckets)))
    sizes = bucketed.groupBy("length", "_bucket").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy(*keys)
    ranked = bucketed.withColumn("_rank", F.row_number().over(inside) - 1).join(sizes, ["length", "_bucket"])
    ranked = ranked.select(*keys, (F.col("_before") + F.col("_rank")).alias("_rank"))

    table = np.array(sorted(placements) or [(0, 0, 0, 1, 0, 0)], dtype=np.int64).T
    shared = spark.sparkContext.broadcast(table)
    schema = ranked.drop("_rank").schema.add("sequence_id", "long").add("offset", "long")

    def place(batches):
        length, start, _, each, first, offset = shared.value
        order = length.astype(np.float64) * 2.0**40 + start
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("length").to_numpy()
            rank = batch.column("_rank").to_numpy()
            at = np.searchsorted(order, own.astype(np.float64) * 2.0**40 + rank, "right") - 1
            along = rank - start[at]
            sequence, slot = first[at] + along // each[at], offset[at] + along % each[at] * own
            kept = [batch.column(c) for c in keys]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, pa.int64()), pa.array(slot, pa.int64())], names=[*keys, "sequence_id", "offset"]
            )

    return ranked.mapInArrow(place, schema)


def packed_documents(
    documents: DataFrame, path: str, end_id: int, capacities: Capacities | None = None
) -> DataFrame:
    """Tokenize, cut and pack documents: one row per piece with its sequence and offset.

    Null and empty texts give the end id alone, null ids stay null, repeated rows are packed each,
    and an empty table gives no rows.
    """
    capacities = capacities or Capacities()
    pieces = pieces_of(documents, path, end_id, capacities.tokens)
    pieces = stored(pieces.withColumn("_spread", F.xxhash64(F.monotonically_increasing_id())), "pieces")
    return pack(pieces, capacities)
