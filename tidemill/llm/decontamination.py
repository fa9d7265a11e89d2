"""Benchmark decontamination: windows of documents that are near copies of a benchmark item.

Words are compared without ASCII case and punctuation. Every item has the SimHash of its
five-word shingles; so has every window of a document that is as long as the item and shares a
shingle with it (a window without one has similarity 0 and cannot count). Fingerprints are cut into one
block more than the radius has bits, so any pair within the radius agrees in a block: looking
blocks up finds them all. These candidates are verified by the exact similarity of the weighted
shingles: the sum of the smaller over the sum of the larger weights, a shingle weighing as often as
it occurs. The radius is so wide that this similarity decides: of 300,000 simulated pairs with a
similarity of exactly 0.8 (9 to 54 different shingles) 6 were beyond 22 bits, 2,328 beyond 16.

The benchmark is a query set held in memory in blocks of bounded size; documents are read where
they lie and are not shuffled.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.blocks import changes, mixed
from tidemill.llm.columns import SPACE, binary_array, codes, lower_ascii, slices, text_bytes

U = np.uint64
STEP = 0x9E3779B97F4A7C15
PUNCTUATION = np.zeros(256, dtype=bool)
PUNCTUATION[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
BLOCK_BYTES = 16 << 20  # of benchmark text per pass over the documents
STRETCH = 1 << 14  # shingles whose bits are summed at once
PAIRS = 1 << 20  # of windows and items looked at together
MATCHES = (
    "doc_id long, item_id long, similarity double, distance int, first_word long, n_words long, byte_start long, byte_end long"
)


@dataclass(frozen=True)
class Rule:
    shingle: int = 5  # items with fewer words are not searched for
    radius: int = 22  # of the fingerprint index
    similarity: float = 0.8


def bare_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all rows' words, the rows' offsets, and where each word lies in its row."""
    data, offsets = text_bytes(column)
    none = np.zeros(0, dtype=np.int64)
    if not len(data):
        return none.astype(U), np.zeros(len(offsets), dtype=np.int64), none, none
    place = np.flatnonzero(~PUNCTUATION[data])
    if not len(place):
        return none.astype(U), np.zeros(len(offsets), dtype=np.int64), none, none
    bounds = np.searchsorted(place, offsets)
    bare = lower_ascii(data[place])
    space = SPACE[bare]
    before, after = np.ones(len(bare), dtype=bool), np.ones(len(bare), dtype=bool)
    before[1:], after[:-1] = space[:-1], space[1:]
    before[bounds[:-1][bounds[:-1] < len(bare)]] = True
    after[bounds[1:][bounds[1:] > 0] - 1] = True
    first, last = np.flatnonzero(~space & before), np.flatnonzero(~space & after)
    ends = np.zeros(len(first) + 1, dtype=np.int64)
    np.cumsum(last - first + 1, out=ends[1:])
    starts = np.searchsorted(first, bounds)
    if not len(first):
        return none.astype(U), starts, none, none
    numbers, distinct = codes(binary_array(bare[~space], ends))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w) for w in distinct.to_pylist()], dtype=U)[numbers]
    row_start = np.repeat(offsets[:-1], np.diff(starts))
    return hashes, starts, place[first] - row_start, place[last] + 1 - row_start


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every ``size`` words in a row; across the ends of rows too."""
    if len(hashes) < size:
        return np.zeros(0, dtype=U)
    found = np.zeros(len(hashes) - size + 1, dtype=U)
    for k in range(size):
        found = found * U(STEP) + hashes[k : len(hashes) - size + 1 + k]
    return mixed(found)


def bit_sums(found: np.ndarray) -> np.ndarray:
    """How many of the hashes before each place have each bit."""
    bits = np.unpackbits(np.ascontiguousarray(found).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(found) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    return sums


def prints(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """SimHash of the hashes from ``begin`` to ``end``: the bits that over half of them have."""
    ones = sums[end] - sums[begin]
    return np.packbits(2 * ones > (end - begin)[:, None], axis=1, bitorder="little").view("<u8").ravel()


def window_prints(found: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The SimHashes of windows in ascending order, however long the text between them is."""
    marks, i = np.zeros(len(begin), dtype=U), 0
    while i < len(begin):
        low = begin[i]
        stop = max(i + 1, int(np.searchsorted(end, low + STRETCH, "right")))
        marks[i:stop] = prints(bit_sums(found[low : end[stop - 1]]), begin[i:stop] - low, end[i:stop] - low)
        i = stop
    return marks


class Benchmark:
    """The items of one block with their shingles and a multi-index of their fingerprints."""

    def __init__(self, ids: list, texts: list, rule: Rule):
        self.rule = rule
        hashes, starts, _, _ = bare_words(pa.array(texts, pa.string()))
        self.items, self.sizes, self.weights, marks = [], [], [], []
        held: dict[int, list[int]] = {}
        for i, item in enumerate(ids):
            own = shingles(hashes[starts[i] : starts[i + 1]], rule.shingle)
            if not len(own):
                continue
            number = len(self.items)
            self.items.append(item)
            self.sizes.append(len(own) + rule.shingle - 1)
            self.weights.append(Counter(own.tolist()))
            marks.append(prints(bit_sums(own), np.array([0]), np.array([len(own)]))[0])
            for shingle in self.weights[-1]:
                held.setdefault(shingle, []).append(number)
        self.sizes, self.marks = np.array(self.sizes, dtype=np.int64), np.array(marks, dtype=U)
        self.known = np.array(sorted(held), dtype=U)
        holders = [held[int(s)] for s in self.known]
        self.held = np.array([number for own in holders for number in own], dtype=np.int64)
        self.held_from = np.cumsum([0, *map(len, holders)])
        self.filter = np.zeros(1 << 20, dtype=bool)
        self.filter[(self.known & U((1 << 20) - 1)).astype(np.int64)] = True
        edges = np.linspace(0, 64, rule.radius + 2).astype(int)
        self.cuts = [(U(a), U((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:])]

    def hits(self, found: np.ndarray) -> np.ndarray:
        """Places of shingles that an item has."""
        at = np.flatnonzero(self.filter[(found & U((1 << 20) - 1)).astype(np.int64)])
        return at[np.isin(found[at], self.known)]

    def candidates(self, marks: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pairs of a window's mark and an item within the radius, and their distance."""
        rows, numbers = [], []
        for shift, mask in self.cuts:
            block = (self.marks[items] >> shift) & mask
            order = np.argsort(block, kind="stable")
            own = (marks >> shift) & mask
            low, high = (np.searchsorted(block[order], own, side) for side in ("left", "right"))
            size = high - low
            rows.append(np.repeat(np.arange(len(marks)), size))
            numbers.append(order[np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)])
        pair = np.unique(np.concatenate(rows) * len(items) + np.concatenate(numbers))
        row, number = pair // len(items), pair % len(items)
        distance = np.bitwise_count(marks[row] ^ self.marks[items][number])
        near = distance <= self.rule.radius
        return row[near], items[number[near]], distance[near].astype(np.int64)

    def similarity(self, item: int, window: np.ndarray) -> float:
        mine, theirs = self.weights[item], Counter(window.tolist())
        shared = sum(min(n, mine[s]) for s, n in theirs.items() if s in mine)
        return shared / (sum(mine.values()) + sum(theirs.values()) - shared)

    def matches(self, found: np.ndarray, hits: np.ndarray) -> list[tuple[int, float, int, int, int]]:
        """Of one text's shingles: the best window of each item that is similar enough.

        Best is the most similar, then the nearest, then the first. A text with fewer words than
        the item is one window. Hits, windows and items are taken in parts of bounded size.
        """
        best: dict[int, tuple] = {}
        number = np.searchsorted(self.known, found[hits])
        first = self.held_from[number]
        many = self.held_from[number + 1] - first
        part = np.cumsum(many) // PAIRS
        edges = [*np.flatnonzero(changes(part)).tolist(), len(hits)]
        for a, b in zip(edges, edges[1:]):
            size = many[a:b]
            item = self.held[np.arange(size.sum()) + np.repeat(first[a:b] - (np.cumsum(size) - size), size)]
            place, words = np.repeat(hits[a:b], size), self.sizes[item]
            for count in np.unique(words).tolist():
                mine = words == count
                self._verified(found, np.unique(place[mine]), np.unique(item[mine]), count, best)
        return [(item, -rank[0], *rank[1:]) for item, rank in sorted(best.items())]

    def _verified(self, found: np.ndarray, hit: np.ndarray, items: np.ndarray, words: int, best: dict[int, tuple]) -> None:
        """Put better matches of items of one number of words in ``best``, from windows around hits."""
        size = self.rule.shingle
        wide = words - size + 1
        step = max(1, PAIRS // (wide * len(items)))
        for k in range(0, len(hit), step):
            begin = np.unique(np.clip(hit[k : k + step, None] - np.arange(wide)[None, :], 0, max(len(found) - wide, 0)))
            end = np.minimum(begin + wide, len(found))
            near = self.candidates(window_prints(found, begin, end), items)
            for row, item, distance in zip(*(x.tolist() for x in near)):
                likeness = self.similarity(item, found[begin[row] : end[row]])
                if likeness >= self.rule.similarity:
                    rank = (-likeness, distance, int(begin[row]), int(end[row] - begin[row] + size - 1))
                    best[item] = min(best.get(item, rank), rank)


def _blocks(benchmark: DataFrame, rule: Rule) -> list:
    """The benchmark broadcast in blocks of bounded size."""
    sparks = benchmark.sparkSession.sparkContext
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = size // BLOCK_BYTES + 1
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").withColumn(
        "block", F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    )
    out = []
    for block in range(count):
        rows = items.filter(F.col("block") == block).collect()
        out.append(sparks.broadcast(Benchmark([r["item_id"] for r in rows], [r["text"] for r in rows], rule)))
    return out


def _found(batch: pa.RecordBatch, index: Benchmark):
    """Row, match and the row's first word for every match in a batch."""
    hashes, starts, begins, ends = bare_words(batch.column("text"))
    size = index.rule.shingle
    found = shingles(hashes, size)
    hits = index.hits(found)
    row = np.searchsorted(starts, hits, "right") - 1
    inside = hits + size <= starts[row + 1]
    hits, row = hits[inside], row[inside]
    edges = [*np.flatnonzero(changes(row)).tolist(), len(row)] if len(row) else [0]
    for a, b in zip(edges, edges[1:]):
        r = int(row[a])
        own = found[starts[r] : starts[r + 1] - size + 1]
        for item, likeness, distance, first, count in index.matches(own, hits[a:b] - starts[r]):
            at = starts[r] + first
            yield r, (index.items[item], likeness, distance, first, count, int(begins[at]), int(ends[at + count - 1]))


def contaminated(documents: DataFrame, benchmark: DataFrame, rule: Rule | None = None) -> DataFrame:
    """One row per document and benchmark item of which it holds a near copy: the best window.

    ``first_word`` and ``n_words`` count words, ``byte_start`` and ``byte_end`` bytes of the text.
    Null and empty texts match nothing; repeated rows are reported each.
    """
    rule = rule or Rule()

    def search(index):
        def run(batches):
            for batch in slices(batches, "text"):
                docs = batch.column("doc_id").to_pylist()
                rows = [(docs[r], *match) for r, match in _found(batch, index.value)]
                kinds = [f.split() for f in MATCHES.split(", ")]
                columns = list(zip(*rows)) or [()] * len(kinds)
                types = {"long": pa.int64(), "double": pa.float64(), "int": pa.int32()}
                yield pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, (_, k) in zip(columns, kinds)], names=[n for n, _ in kinds])

        return run

    asked = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return reduce(DataFrame.unionByName, [asked.mapInArrow(search(i), MATCHES) for i in _blocks(benchmark, rule)])


def decontaminated(documents: DataFrame, benchmark: DataFrame, rule: Rule | None = None) -> DataFrame:
    """The documents without a near copy of any benchmark item, with all their columns."""
    rule = rule or Rule()

    def clean(index):
        def run(batches):
            for batch in slices(batches, "text"):
                keep = np.ones(batch.num_rows, dtype=bool)
                for r, _ in _found(batch, index.value):
                    keep[r] = False
                yield batch.filter(pa.array(keep))

        return run

    for index in _blocks(benchmark, rule or Rule()):
        documents = documents.mapInArrow(clean(index), documents.schema)
    return documents
