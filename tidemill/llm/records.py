"""Token-ID output as length-delimited binary records, with a separate offset index.

File format, as TFRecord frames it, integers little-endian: length (8 bytes), masked CRC-32C of
those 8 bytes (4), payload, masked CRC-32C of the payload (4). A payload holds one document:
its row's key as a signed 64-bit integer, then its ids, two bytes each where the vocabulary allows it, else four.
The index has one row per record, so a reader can fetch records in any order.
"""

from __future__ import annotations

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.columns import SLICE_BYTES, slices
from tidemill.llm.frames import filesystem
from tidemill.llm.tokens import encoder, ids_crc32
from tidemill.session import stored

INDEX = "doc_id long, file string, at long, size long, first long, n_tokens long"
READ = "doc_id long, file string, first long, n_tokens long, ids_crc32 long"
# Fixed values of the record format: the CRC-32C polynomial, reflected, and the mask's constant.
CASTAGNOLI, MASK = 0x82F63B78, 0xA282EAD8
LANES = 256


def _byte_table() -> np.ndarray:
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(CASTAGNOLI), byte >> 1)
    return byte


TABLE = _byte_table()


def _shift_tables(moved: np.ndarray) -> np.ndarray:
    """From where 32 single bits move: what each value of each state byte moves to."""
    bits = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(bool)
    return np.stack([
        np.bitwise_xor.reduce(np.where(bits, moved[8 * k : 8 * k + 8], np.uint32(0)), axis=1) for k in range(4)
    ])


def _shifted(states: np.ndarray, tables: np.ndarray) -> np.ndarray:
    return (
        tables[0][states & 0xFF] ^ tables[1][(states >> 8) & 0xFF]
        ^ tables[2][(states >> 16) & 0xFF] ^ tables[3][states >> 24]
    )


def _row_shift() -> np.ndarray:
    """Tables that carry a state over ``LANES`` zero bytes."""
    states = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(LANES):
        states = TABLE[states & 0xFF] ^ (states >> 8)
    return _shift_tables(states)


ROW_SHIFT = _row_shift()


def crc32c(messages: list[bytes]) -> np.ndarray:
    """CRC-32C of each message (of four bytes or more).

    A CRC is linear: messages become rows of ``LANES`` bytes with zeros in front, all rows are
    reduced side by side, and neighbouring rows are folded until one is left of each message.
    """
    lengths = np.fromiter(map(len, messages), dtype=np.int64, count=len(messages))
    if not len(lengths):
        return np.zeros(0, dtype=np.uint32)
    data = np.frombuffer(b"".join(messages), dtype=np.uint8)
    rows = -(-lengths // LANES)
    starts = np.cumsum(rows) * LANES - lengths
    padded = np.zeros(int(rows.sum()) * LANES, dtype=np.uint8)
    padded[np.arange(len(data)) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)] = data
    for k in range(4):
        padded[starts + k] ^= 0xFF
    columns = np.ascontiguousarray(padded.reshape(-1, LANES).T)
    states = np.zeros(columns.shape[1], dtype=np.uint32)
    for column in columns:
        states = TABLE[(states ^ column) & 0xFF] ^ (states >> 8)
    shift = ROW_SHIFT
    while len(states) > len(lengths):
        pairs = (rows + 1) // 2
        ends = np.cumsum(2 * pairs)
        even = np.zeros(int(ends[-1]), dtype=np.uint32)
        even[np.arange(len(states)) + np.repeat(ends - np.cumsum(rows), rows)] = states
        states = _shifted(even[0::2], shift) ^ even[1::2]
        rows = pairs
        shift = _shift_tables(_shifted(_shifted(np.uint32(1) << np.arange(32, dtype=np.uint32), shift), shift))
    return states ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(MASK)


def framed(payloads: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(p)) for p in payloads]
    checks = zip(masked(crc32c(lengths)).tolist(), masked(crc32c(payloads)).tolist())
    return [
        n + struct.pack("<I", a) + p + struct.pack("<I", b) for n, p, (a, b) in zip(lengths, payloads, checks)
    ]


def payloads_of(records: list[bytes]) -> list[bytes]:
    """The payloads of framed records; a record that was damaged is an error."""
    payloads = [r[12:-4] for r in records]
    heads = masked(crc32c([r[:8] for r in records])).tolist()
    bodies = masked(crc32c(payloads)).tolist()
    for record, payload, head, body in zip(records, payloads, heads, bodies):
        if struct.unpack_from("<QI", record) != (len(payload), head) or struct.unpack("<I", record[-4:])[0] != body:
            raise ValueError("a record is damaged")
    return payloads


def write_records(documents: DataFrame, path: str, end_id: int, folder: str, wide_ids: bool = False) -> DataFrame:
    """Write each document's ids and ``end_id`` in ascending ``doc_id`` order; return the index.

    Documents are range-partitioned by ``doc_id`` (copies of an id by a hash of the text), so
    every file holds one range and files follow each other. A task writes a file of its own
    name, and only files of finished tasks are in the index, which is itself stored: a lost
    executor leaves at most a file nobody reads. Null texts count as empty; rows without a
    ``doc_id`` come first. ``path`` is the tokenizer file, ``folder`` the shared folder of the
    files; ``wide_ids`` stores four bytes per id (vocabularies beyond 65,536).
    """
    ordered = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie")
    ).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")

    def write(batches):
        files, root = filesystem(folder)
        files.create_dir(root, recursive=True)
        name = f"{root}/{uuid.uuid4().hex}.records"
        enc = encoder(path)
        wide = "<u4" if wide_ids else "<u2"
        at = first = 0
        out = None
        try:
            for batch in slices(batches, "text"):
                out = out or files.open_output_stream(name, buffer_size=1 << 20)
                ids, bounds = enc.encode(batch.column("text"))
                ids, end = ids.astype(wide), np.array([end_id], dtype=wide).tobytes()
                docs, rows = batch.column("doc_id").to_pylist(), []
                records = framed([
                    struct.pack("<q?", doc or 0, doc is not None) + ids[bounds[i] : bounds[i + 1]].tobytes() + end
                    for i, doc in enumerate(docs)
                ])
                out.write(b"".join(records))
                for doc, record, n in zip(docs, records, np.diff(bounds).tolist()):
                    rows.append((doc, name, at, len(record), first, n + 1))
                    at, first = at + len(record), first + n + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (
                        pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "file", "at", "size", "first", "n_tokens"],
                )
        finally:
            if out:
                out.close()

    index = ordered.mapInArrow(write, INDEX)
    return stored(index, "record-index")


def _parts(batch: pa.RecordBatch):
    """An index batch in parts whose records fit in memory together."""
    group = np.cumsum(batch.column("size").to_numpy()) // SLICE_BYTES
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    return (batch.slice(a, b - a) for a, b in zip(edges, edges[1:]) if b > a)


def read_records(index: DataFrame, folder: str, wide: bool = False) -> DataFrame:
    """Read the records that an index lists, in any order, and check every checksum.

    Each file is one task's work: its records are fetched by their offsets.
    """
    files = index.select("file").distinct().count()
    placed = index.repartition(max(1, files), "file").sortWithinPartitions("file", "at")

    def read(batches):
        opened, source, current = filesystem(folder)[0], None, None
        for batch in (part for whole in batches for part in _parts(whole)):
            rows, listed = [], list(zip(*(batch.column(c).to_pylist() for c in ("file", "at", "size", "first"))))
            records = []
            for file, at, size, _ in listed:
                if file != current:
                    source, current = opened.open_input_file(file), file
                records.append(source.read_at(size, at))
            for (file, _, _, first), payload in zip(listed, payloads_of(records)):
                doc, known = struct.unpack_from("<q?", payload)
                ids = np.frombuffer(payload, dtype="<u4" if wide else "<u2", offset=9)
                rows.append((doc if known else None, file, first, len(ids), ids_crc32(ids)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "file", "first", "n_tokens", "ids_crc32"],
            ) if rows else batch.slice(0, 0)

    return placed.mapInArrow(read, READ)


def with_starts(records: DataFrame) -> DataFrame:
    """Add ``start``: the ids of all documents before, from one total per file."""
    totals = records.groupBy("file").agg(F.sum("n_tokens").alias("total"), F.min(F.struct("doc_id", "first")).alias("least"))
    before = Window.orderBy("least", "file").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("file", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return records.join(totals, "file").withColumn("start", F.col("base") + F.col("first")).drop("base")
