"""SimHash fingerprints of word shingles, and near-duplicate groups by tiled exact comparison.

Fingerprints that differ in at most ``radius`` bits are linked. Each of ``segments`` equal
parts of a fingerprint is counted for ones; these counts differ by at most the number of
differing bits, so tiles (fingerprints with equal counts, in blocks of bounded size) are only
compared where their counts differ by ``radius`` in sum. Within a pair of tiles all
fingerprints are compared by exclusive-or and bit count, and links are passed on as a spanning
forest, so a large group does not become all its pairs.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.columns import SPACE, lower_ascii, slices, text_bytes
from tidemill.llm.components import components
from tidemill.session import stored

BLOCK = 1 << 18


def shingle_spans(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """Rows' words joined by one space, where each shingle of ``size`` words begins and ends in
    that, and the offsets of each row's shingles. Fewer words make one shingle, none make none."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return b"", none, none, np.zeros(len(offsets), dtype=np.int64)
    space = SPACE[data]
    before, after = np.ones(len(data), dtype=bool), np.ones(len(data), dtype=bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = True
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    first, last = np.flatnonzero(~space & before), np.flatnonzero(~space & after)
    kept = ~space
    kept[1:] |= space[1:] & ~space[:-1]  # one sign of white space after each word
    place = np.cumsum(kept) - 1
    joined = np.where(space, np.uint8(32), data)[kept].tobytes()
    begins, ends = place[first], place[last] + 1
    bounds = np.searchsorted(first, offsets)
    words = np.diff(bounds)
    shingles = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    starts = np.zeros(len(shingles) + 1, dtype=np.int64)
    np.cumsum(shingles, out=starts[1:])
    at = np.arange(starts[-1]) + np.repeat(bounds[:-1] - starts[:-1], shingles)
    until = at + np.repeat(np.minimum(words, size) - 1, shingles)
    return joined, begins[at], ends[until], starts


def shingle_hashes(joined: bytes, begins: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in zip(begins.tolist(), ends.tolist())], dtype=np.uint64)


def simhash(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes, as a signed number; 0 for none."""
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), BLOCK):
        part = np.ascontiguousarray(hashes[i : i + BLOCK]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(documents: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp, tag``: the SimHash of each whole text's lower-cased word shingles, repeats
    included, and a hash of the text that tells rows with one id apart.

    Null, empty and blank texts have the fingerprint zero.
    """

    def marks(batches):
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            joined, begins, ends, starts = shingle_spans(lower_ascii(data), offsets, shingle)
            hashes = shingle_hashes(joined, begins, ends)
            found = [simhash(hashes[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, pa.int64()), batch.column("tag")], names=["doc_id", "fp", "tag"]
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_tag(documents).alias("tag"))
    return rows.mapInArrow(marks, "doc_id long, fp long, tag long")


def text_tag(documents: DataFrame):
    return F.xxhash64(documents["text"])


def forest(left: np.ndarray, right: np.ndarray, radius: int, block: int = 256) -> list[tuple[int, int]]:
    """A spanning forest of the links between two tiles (of one tile, if they are the same)."""
    nodes, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    label = np.arange(len(nodes))
    a_at, b_at = place[: len(left)], place[len(left) :]
    a_bits, b_bits = left.view(np.uint64), right.view(np.uint64)
    for i in range(0, len(left), block):
        near = np.bitwise_count(a_bits[i : i + block, None] ^ b_bits[None, :]) <= radius
        rows, columns = np.nonzero(near)
        a, b = a_at[i + rows], b_at[columns]
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label = label[label]
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return list(zip(nodes[moved].tolist(), nodes[label[moved]].tolist()))


def near_links(prints: DataFrame, radius: int, segments: int = 4, tile: int = 2048) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` that connect all within ``radius`` bits.

    ``tile`` bounds the fingerprints compared at once; more ``segments`` prune more tile pairs
    at the price of more copies of each tile.
    """
    width = 64 // segments
    mask = (1 << width) - 1
    ones = [F.bit_count(F.shiftrightunsigned("fp", width * k).bitwiseAND(F.lit(mask))) for k in range(segments)]
    base = width + 1 + 2 * radius  # room for neighbours below 0 and above the width
    cell = sum(((c + radius) * F.lit(base**k) for k, c in enumerate(ones)), F.lit(0)).cast("long")
    placed = stored(prints.select("fp").distinct().withColumn("cell", cell), "prints")
    sizes = placed.groupBy("cell").agg(F.ceil(F.count("*") / tile).alias("parts"))
    tiles = (
        placed.join(sizes, "cell")
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")))
        .groupBy("cell", "part").agg(F.collect_list("fp").alias("fps"))
    )
    tiles = stored(tiles, "tiles")
    steps = [s for s in product(range(-radius, radius + 1), repeat=segments) if sum(map(abs, s)) <= radius]
    steps = [s for s in steps if s >= (0,) * segments]  # each pair of cells from one side only
    moves = F.array(*[F.lit(sum(d * base**k for k, d in enumerate(s))).cast("long") for s in steps])
    left = tiles.select(
        F.col("part").alias("own_part"), F.col("fps").alias("own"), F.explode(moves).alias("move"), F.col("cell").alias("from"),
    ).withColumn("cell", F.col("from") + F.col("move"))
    pairs = left.join(tiles, "cell").filter("move <> 0 or own_part <= part").select("own", "fps")

    def compare(batches):
        for batch in batches:
            links = []
            for own, other in zip(batch.column("own"), batch.column("fps")):
                links += forest(own.values.to_numpy(), other.values.to_numpy(), radius)
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long")


def near_duplicates(documents: DataFrame, shingle: int = 3, radius: int = 2) -> DataFrame:
    """``doc_id, fp, tag, root, component_id``: the smallest ``doc_id`` linked to each document.

    ``root`` is the smallest fingerprint of the group, which every member shares.

    Documents with one fingerprint are one node, however many they are. Documents without an
    id get their group's smallest id, or null if no member has one.
    """
    prints = stored(fingerprints(documents, shingle), "fingerprints")
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    nodes = components(near_links(prints, radius)).withColumnRenamed("node", "fp")
    known = least.join(nodes, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    known = stored(known, "nodes")
    smallest = known.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(known.join(smallest, "root").select("fp", "root", "component_id"), "fp")
