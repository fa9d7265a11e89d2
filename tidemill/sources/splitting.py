"""Records of large files whose separators may lie inside quotes, read by many tasks.

Spark's text source cuts a file into splits at a separator byte, but whether that byte ends a record
depends on everything before it. Each split is summed up first; a running sum over the splits of a file
gives the state in which each one begins, and then all splits are cut into records on their own.
Only a record that crosses a border is put together from its pieces, by a shuffle of these alone.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemill.session import stored

# Workers get these functions themselves, so they need not have this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WHOLE, TAIL, MIDDLE, HEAD = range(4)
RECORDS = "file string, split long, kind int, first boolean, record string"
Cutter = Callable[[pa.Array, tuple[int, int]], tuple[pa.Array, list[int], tuple[int, int]]]


def chunks(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """``file, split, value``: the text between separators, in order inside a split."""
    text = spark.read.option("lineSep", separator).text(path)
    return text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.Array]]:
    """The stretches of a batch that belong to one split."""
    file, split = batch.column("file"), batch.column("split").to_numpy(zero_copy_only=False)
    codes = pc.dictionary_encode(file).indices.to_numpy(zero_copy_only=False)
    edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(split) != 0)) + 1
    for a, b in zip([0, *edges], [*edges, batch.num_rows]):
        if b > a:
            yield (file[int(a)].as_py(), int(split[a])), batch.column("value").slice(a, b - a)


def _cut(rows: DataFrame, starts: dict[tuple[str, int], tuple[int, int]], cutter: Cutter, join: str, borders: bool) -> DataFrame:
    """The records inside splits, or the pieces of those that cross a border (``borders``).

    ``starts`` has the state (inside quotes, depth) of every split that does not begin as a file does. A
    record begins at depth 0, or 1 in an array.
    """
    told = rows.sparkSession.sparkContext.broadcast(starts)

    def cut(batches):
        place, state, held, begun, first = None, (0, 0), [], True, False
        out = []

        def rest():
            if held and borders:
                out.append((*place, HEAD if begun else MIDDLE, first, join.join(held)))

        for batch in batches:
            wholes = []
            for own, values in _runs(batch):
                if own != place:
                    rest()
                    place, held, first = own, [], own[1] == 0
                    state = told.value.get(own, (0, 0))
                    begun = state[0] == 0 and state[1] <= 1
                values, ends, state = cutter(values, state)
                done = 0
                if ends:
                    if held or not begun:
                        text = join.join([*held, *values.slice(0, ends[0]).to_pylist()])
                        kind = WHOLE if begun else TAIL
                        if (kind != WHOLE) == borders:
                            out.append((*place, kind, first, text))
                        held, begun, first, done = [], True, first and kind != WHOLE, ends[0]
                    if not borders and done < ends[-1]:
                        offsets = pa.array([done, *[e for e in ends if e > done]], pa.int32())
                        texts = pc.binary_join(pa.ListArray.from_arrays(offsets, values.cast(pa.string())), join)
                        wholes.append((place, first, texts))
                    first = first and done == ends[-1]
                    done = ends[-1]
                held = [*held, *values.slice(done).to_pylist()]
            yield _rows(out)
            out.clear()
            for (file, split), opens, texts in wholes:
                n = len(texts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([file] * n, pa.string()), pa.array([split] * n, pa.int64()), pa.array([WHOLE] * n, pa.int32()),
                    pa.array([opens, *[False] * (n - 1)]), texts,
                ], names=["file", "split", "kind", "first", "record"])
        rest()
        yield _rows(out)

    return rows.mapInArrow(cut, RECORDS)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
    names = ("file", "split", "kind", "first", "record")
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=list(names))


def _joined(pieces: DataFrame, join: str) -> DataFrame:
    """Records from the pieces that borders cut them into: a head, what goes on, and a tail unless the file ends."""
    order = Window.partitionBy("file").orderBy("split", "kind")
    heads = F.sum((F.col("kind") == HEAD).cast("long")).over(order)
    numbered = pieces.select("file", "split", "kind").withColumn("_number", heads)  # two small rows per split
    parts = pieces.join(numbered, ["file", "split", "kind"]).groupBy("file", "_number").agg(
        F.array_sort(F.collect_list(F.struct("split", "kind", "record"))).alias("_parts"), F.max("first").alias("first"),
        F.max((F.col("kind") == TAIL).cast("int")).alias("_ended"),
    )
    text = F.array_join(F.transform("_parts", lambda p: p["record"]), join)
    kind = F.when(F.col("_ended") == 1, WHOLE).otherwise(HEAD)
    return parts.select("file", F.col("_parts")[0]["split"].alias("split"), kind.alias("kind"), "first", text.alias("record"))


def _starts(sums: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
    """Where splits begin, from ``file, split, quotes, depth0, depth1``: (inside quotes, depth).

    One short row per split reaches the driver, if its state is not that of a new file.
    """
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2
    sums = sums.withColumn("inside", inside)
    sums = sums.withColumn("_delta", F.when(F.col("inside") == 1, F.col("depth1")).otherwise(F.col("depth0")))
    sums = sums.withColumn("depth", F.coalesce(F.sum("_delta").over(before), F.lit(0)))
    rows = sums.filter((F.col("split") > 0) & ((F.col("inside") == 1) | (F.col("depth") > 0))).collect()
    return {(r.file, r.split): (r.inside, r.depth) for r in rows}


def _lines(values: pa.Array, state: tuple[int, int]):
    """Lines end a record where the quotes so far are even."""
    quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False)
    so_far = state[0] + np.cumsum(quotes, dtype=np.int64)
    return values, (np.flatnonzero(so_far % 2 == 0) + 1).tolist(), (int(so_far[-1] % 2), 0)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``file, first, record``: the records of quoted CSV files as text, line breaks inside quotes kept.

    ``first`` marks each file's first record. Lines end with LF or CR LF; quotes are doubled inside quotes.
    """
    rows = chunks(spark, path, "\n")
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    none = F.lit(0).alias
    starts = _starts(rows.groupBy("file", "split").agg(F.sum(quotes).alias("quotes")).select("*", none("depth0"), none("depth1")))
    found = _cut(rows, starts, _lines, "\n", False).unionByName(_joined(_cut(rows, starts, _lines, "\n", True), "\n"))
    return found.select("file", "first", F.regexp_replace("record", "\r$", "").alias("record")).filter("record <> ''")


def read_quoted_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV files with a header, quoted fields, line breaks in them and doubled quotes, each file read by many tasks.

    The same rows as ``read_csv(..., multiline=True)``, which reads a file in one task.
    """
    records = csv_records(spark, path).filter(~F.col("first"))
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    return records.select(F.from_csv("record", schema, options).alias("_row")).select("_row.*")


def _marks(data: np.ndarray, state: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """After each byte of JSON text: quotes so far, and the depth of braces and brackets outside strings."""
    slash = data == 0x5C
    place = np.arange(len(data))
    last = np.maximum.accumulate(np.where(slash, -1, place))
    escaped = np.zeros(len(data), dtype=bool)
    escaped[1:] = (place[:-1] - last[:-1]) % 2 == 1
    quotes = state[0] + np.cumsum((data == 0x22) & ~escaped, dtype=np.int64)
    delta = np.isin(data, (0x7B, 0x5B)).astype(np.int64) - np.isin(data, (0x7D, 0x5D))
    return quotes, state[1] + np.cumsum(np.where(quotes % 2 == 0, delta, 0))


def _closed(values: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Chunks with the brace at which they were cut, their bytes, and where each one ends."""
    brace, nothing = (pa.scalar(x, pa.large_string()) for x in ("}", ""))
    values = pc.binary_join_element_wise(values.cast(pa.large_string()), brace, nothing)
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    return values, np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets[1:] - offsets[0] - 1


def _objects(values: pa.Array, state: tuple[int, int]):
    """A brace outside strings that leaves only the array open ends an element."""
    values, data, ends = _closed(values)
    quotes, depth = _marks(data, state)
    done = np.flatnonzero((quotes[ends] % 2 == 0) & (depth[ends] == 1)) + 1
    return values, done.tolist(), (int(quotes[-1] % 2), int(depth[-1]))


def _depths(rows: DataFrame) -> DataFrame:
    """Per split: its quotes, and how much deeper it ends when it begins outside or inside a string."""

    def sums(batches):
        place, state = None, [(0, 0), (1, 0)]
        for batch in batches:
            out = []
            for own, values in _runs(batch):
                if own != place and place is not None:
                    out.append((*place, state[0][0], state[0][1], state[1][1]))
                if own != place:
                    place, state = own, [(0, 0), (1, 0)]
                _, data, _ = _closed(values)
                ends = [_marks(data, s) for s in state]
                state = [(int(q[-1] % 2), int(d[-1])) for q, d in ends]
            yield told(out)
        yield told([(*place, state[0][0], state[0][1], state[1][1])] if place else [])

    def told(out):
        kinds = [pa.string(), *[pa.int64()] * 4]
        names = ["file", "split", "quotes", "depth0", "depth1"]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    return rows.mapInArrow(sums, "file string, split long, quotes long, depth0 long, depth1 long")


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """``file, element``: the objects of files that hold one JSON array each, as text.

    A file that is not a whole array of objects yields nothing.
    """
    rows = chunks(spark, path, "}")
    starts = _starts(_depths(rows))
    found = _cut(rows, starts, _objects, "", False).unionByName(_joined(_cut(rows, starts, _objects, "", True), ""))
    # What follows the last element is no element, and ends with the brace that every chunk got.
    lead = lambda sign: F.regexp_extract("record", rf"(?s)^\s*{sign}\s*(\{{.*\}})$", 1)
    element = F.when(F.col("first"), lead(r"\[")).otherwise(lead(","))
    closing = F.when(F.col("first"), F.lit(r"^\s*\[\s*\]\s*\}$")).otherwise(F.lit(r"^\s*\]\s*\}$"))
    kept = stored(found.select("file", "kind", element.alias("element"), F.regexp_like("record", closing).alias("ends")), "json_elements")
    whole = (F.col("kind") == WHOLE) & (F.col("element") != "") & F.try_parse_json("element").isNotNull()
    files = kept.groupBy("file").agg(
        F.min((F.col("ends") | whole).cast("int")).alias("_right"), F.sum(F.col("ends").cast("int")).alias("_ends")
    )
    good = files.filter("_right = 1 AND _ends = 1").select(F.col("file").alias("_file"))
    return kept.filter(~F.col("ends")).join(good, F.col("file") == F.col("_file"), "left_semi").select("file", "element")


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The objects of files of one JSON array each, every file read by many tasks.

    A broken file yields nothing; an object whose fields do not fit the schema is left out.
    """
    rows = json_elements(spark, path).select(F.from_json("element", f"{schema}, _broken STRING", {
        "columnNameOfCorruptRecord": "_broken"}).alias("_row")).select("_row.*")
    return rows.filter(F.col("_broken").isNull()).drop("_broken")
