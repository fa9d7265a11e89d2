"""WARC archives: identical payloads as revisits, and a normaliser of whole-file gzip streams.

An archive compressed as one stream cannot be read at a record. The normaliser inflates it
once, front to back, writes every record as a gzip member of its own, and stores where each
begins in an index beside the archives; a reader then fetches any record by its offset.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.columns import slices
from tidemill.llm.frames import filesystem
from tidemill.session import stored

CHUNK = 1 << 20
FILES = "file string, records long"
INDEX = "file string, at long, size long, record_id string, record_type string"
PARSED = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = re.compile(r"<urn:page:(-?\d*)>")


def arrow_rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    names = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, names)], names=[n for n, _ in names])


def record_id(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def page_of(name: str | None) -> int | None:
    found = ID.fullmatch(name or "")
    return int(found[1]) if found and found[1] else None


def record_bytes(page: int | None, url: str | None, payload: bytes, digest: str, keeper: int | None, revisit: bool) -> bytes:
    """One record: an HTTP response, of which a revisit has the head only."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page)}"]
    if url:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(keeper)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(record: bytes) -> tuple[dict[str, str], bytes]:
    """The named fields of a record and its block."""
    head, _, rest = record.partition(b"\r\n\r\n")
    named = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    named = {k.lower(): v for k, v in named.items()}
    return named, rest[: int(named["content-length"])]


def with_keepers(pages: DataFrame, least_bytes: int = 1000) -> DataFrame:
    """Pages with their payload's digest and ``keeper``, the largest ``page_id`` with that payload.

    Payloads under ``least_bytes`` have no keeper, nor have those of rows that all lack an id.
    """
    marked = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("digest", F.sha1(F.encode("html", "utf-8")))
    large = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")).filter(F.octet_length("html") >= least_bytes)
    keepers = large.groupBy(F.sha1(F.encode("html", "utf-8")).alias("digest")).agg(F.max("page_id").cast("long").alias("keeper"))
    return marked.join(keepers, "digest", "left")


def write_monolithic(pages: DataFrame, folder: str, level: int = 4) -> DataFrame:
    """Write one archive per partition, each a single gzip stream; return the stored list of files.

    The row whose id is its payload's keeper is the response and other rows with that payload
    revisit it; rows that repeat the keeper's id are responses too.
    """

    def write(batches):
        files, root = filesystem(folder)
        files.create_dir(root, recursive=True)
        name, out, packer, n = f"{root}/{uuid.uuid4().hex}.warc.gz", None, None, 0
        try:
            for batch in slices(batches, "html"):
                if out is None:
                    out, packer = files.open_output_stream(name, compression=None), zlib.compressobj(level, wbits=31)
                rows = zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "digest", "keeper")))
                for page, url, html, digest, keeper in rows:
                    revisit = keeper is not None and page != keeper
                    out.write(packer.compress(record_bytes(page, url, html.encode(), digest, keeper, revisit)))
                    n += 1
            if out:
                out.write(packer.flush())
        finally:
            if out:
                out.close()
        yield arrow_rows([(name, n)] if n else [], FILES)

    return stored(pages.mapInArrow(write, FILES), "warc-files")


def inflated(source):
    """The records of a gzip stream (of one member or of several), as bytes, one at a time."""
    unpacker, held, at = zlib.decompressobj(wbits=31), bytearray(), 0
    while True:
        piece = source.read(CHUNK)
        if not piece:
            break
        while piece:
            held += unpacker.decompress(piece)
            piece = unpacker.unused_data
            if piece:
                unpacker = zlib.decompressobj(wbits=31)
        while (end := held.find(b"\r\n\r\n", at)) >= 0:
            size = int(re.search(rb"(?mi)^Content-Length: *(\d+)", held[at:end])[1])
            stop = end + 4 + size + 4
            if stop > len(held):
                break
            yield bytes(held[at:stop])
            at = stop
        del held[:at]
        at = 0
    if held:
        raise ValueError("the archive ends inside a record")


def normalise(files: DataFrame, folder: str, level: int = 6) -> DataFrame:
    """Rewrite archives with one gzip member per record; return the stored offset index.

    Each archive is one task's work and is streamed: memory holds one record beside a chunk.
    """
    count = files.count()

    def rewrite(batches):
        system, root = filesystem(folder)
        system.create_dir(root, recursive=True)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                target, rows, at = f"{root}/{uuid.uuid4().hex}.warc.gz", [], 0
                with system.open_input_stream(name, compression=None) as source, system.open_output_stream(target, compression=None) as out:
                    for record in inflated(source):
                        named, _ = parsed(record)
                        member = gzip.compress(record, level, mtime=0)
                        out.write(member)
                        rows.append((target, at, len(member), named["warc-record-id"], named["warc-type"]))
                        at += len(member)
                        if len(rows) >= 10_000:
                            yield arrow_rows(rows, INDEX)
                            rows = []
                yield arrow_rows(rows, INDEX)

    return stored(files.repartition(max(1, count), "file").mapInArrow(rewrite, INDEX), "warc-index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Fetch every record of an index by its offset; digests of whole payloads are checked."""
    count = index.select("file").distinct().count()

    def read(batches):
        system, source, current = filesystem(folder)[0], None, None
        for batch in batches:
            rows = []
            for name, at, size in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "size"))):
                if name != current:
                    source, current = system.open_input_file(name), name
                named, block = parsed(zlib.decompress(source.read_at(size, at), wbits=31))
                http, _, payload = block.partition(b"\r\n\r\n")
                digest = named["warc-payload-digest"].removeprefix("sha1:")
                length = int(re.search(rb"(?mi)^Content-Length: *(\d+)", http)[1])
                if named["warc-type"] == "response" and (len(payload), hashlib.sha1(payload).hexdigest()) != (length, digest):
                    raise ValueError(f"the payload of {named['warc-record-id']} is damaged")
                rows.append((
                    page_of(named["warc-record-id"]), length, digest, named["warc-type"], page_of(named.get("warc-refers-to"))
                ))
            yield arrow_rows(rows, PARSED)

    placed = index.select("file", "at", "size").repartition(max(1, count), "file").sortWithinPartitions("file", "at")
    return placed.mapInArrow(read, PARSED)


def archived(pages: DataFrame, folder: str) -> DataFrame:
    """Write pages as monolithic archives, normalise them, and read all records back.

    Null html is an empty payload, a null url leaves out the field, a row without ``page_id``
    has a record without a number; repeated rows are repeated records.
    """
    files = write_monolithic(with_keepers(pages), f"{folder}/monolithic")
    return read_records(normalise(files, f"{folder}/archives"), folder)
