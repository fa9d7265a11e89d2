"""Rows in blocks of bounded size: compressed packets that meet what was found about their ids."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from tidemill.llm.columns import slices

LAST = (1 << 63) - 1  # stands for a missing doc_id: after every other document
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(31))) * U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(29))


def doc_ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows begin to differ from the row before."""
    new = np.ones(len(columns[0]), dtype=bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return new


def block_of(docs: np.ndarray, blocks: int) -> np.ndarray:
    return (mixed(docs.astype(np.int64).view(U)) % U(blocks)).astype(np.int32)


def text_blocks(documents: DataFrame, blocks: int) -> DataFrame:
    """Whole rows in compressed packets, by a hash of their id."""

    def pack(batches):
        packer = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, "text"):
            number = block_of(doc_ids(batch.column("doc_id")), blocks)
            order = np.argsort(number, kind="stable")
            number = number[order]
            edges = [*np.flatnonzero(changes(number)).tolist(), len(number)]
            sent = []
            for a, b in zip(edges, edges[1:]):
                sink = io.BytesIO()
                with pa.ipc.new_stream(sink, batch.schema) as writer:
                    writer.write_batch(batch.take(pa.array(order[a:b])))
                sent.append(packer.compress(sink.getvalue()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(number[edges[:-1]], pa.int32()), pa.array(sent, pa.binary())], names=["block", "packet"]
            )

    return documents.mapInArrow(pack, "block int, packet binary")


def packet_rows(packet: bytes):
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(packet))


def block_rows(table: pa.Table):
    """The rows of a block in batches of bounded bytes, far fewer than its packets."""
    packets = [packet_rows(p).read_all() for p in table.column("packet").to_pylist()]
    if packets:
        yield from slices(pa.concat_tables(packets).combine_chunks().to_batches(), "text")


def repeated_ids(table: pa.Table) -> set[int]:
    """Ids that several rows of a block have."""
    docs = [doc_ids(b.column("doc_id")) for packet in table.column("packet").to_pylist() for b in packet_rows(packet)]
    values, times = np.unique(np.concatenate(docs), return_counts=True) if docs else (np.zeros(0), np.zeros(0))
    return set(values[times > 1].tolist())
