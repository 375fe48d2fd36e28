"""WARC archives compressed record by record with a Zstandard dictionary, and their reader.

Pages with equal payloads are stored once: the page with the largest identifier is the response and
the others are revisits that refer to it. Tasks write archives of bounded size. An archive starts
with a skippable frame that holds its dictionary, trained on a sample of its own records of at most
``SAMPLE_BYTES``; each record is a frame of its own, so any record can be read by itself. Only
archives named in the committed manifest belong to the result.

A NULL payload is empty; a NULL address is written as ``urn:unknown``. Equal payloads are those
with equal SHA-1 and length. Of rows with equal payloads and the largest identifier (a repeated
row) each is a response; NULL is smaller than any identifier. An empty table gives no archives and
an empty result. Only identifier, address and payload columns are read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rostra.llm import storage
from rostra.llm.common import prepare, table, utf8
from rostra.session import shared_dir, staged

ARCHIVE_BYTES = 32 << 20  # of records, before compression
DICTIONARY_BYTES, SAMPLE_BYTES = 32 << 10, 2 << 20
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"

# Fixed values of the format: frame magic, record layout, revisit profile.
MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'page:{page}')}>"


def _head(first: str, fields: list[tuple[str, object]]) -> bytes:
    return "".join([first, "\r\n", *(f"{k}: {v}\r\n" for k, v in fields), "\r\n"]).encode()


def make_record(page: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    address = "".join((url or "").split()) or "urn:unknown"
    http = _head(
        "HTTP/1.1 200 OK", [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]
    )
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", record_id(page)),
        ("WARC-Date", date),
        ("WARC-Target-URI", address),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
    ]
    if page is not None:
        fields.append(("WARC-Page-ID", page))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
        fields.append(("WARC-Refers-To-Page-ID", refers_to))
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", len(block))]
    return _head("WARC/1.1", fields) + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def parse_record(record: bytes) -> dict:
    """Identifier, length and digest of the payload, type, and what it refers to."""
    head, _, rest = record.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record has another length than it says")
    http, _, payload = block.partition(b"\r\n\r\n")
    found = fields["warc-payload-digest"].removeprefix("sha1:")
    revisit = fields["warc-type"] == "revisit"
    if not revisit and digest(payload) != found:
        raise ValueError("a payload has another digest than it says")
    page, refers = fields.get("warc-page-id"), fields.get("warc-refers-to-page-id")
    return {
        "page_id": None if page is None else int(page),
        "payload_bytes": int(_fields(http)["content-length"]),
        "payload_digest": found,
        "record_type": fields["warc-type"],
        "refers_to": None if refers is None else int(refers),
        "url": fields["warc-target-uri"],
        "payload": None if revisit else payload,
    }


def make_dictionary(records: list[bytes]) -> bytes:
    """A dictionary trained on evenly spread records; their plain text if there are too few."""
    step = max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))
    sample, held = [], 0
    for r in records[::step]:
        r = r[: SAMPLE_BYTES - held]
        if len(r) >= 8:
            sample.append(r)
        held += len(r)
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=512, d=8, f=18, accel=4).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[:DICTIONARY_BYTES]


def write_archive(out, records: list[bytes]) -> None:
    dictionary = make_dictionary(records)
    out.write(struct.pack("<II", MAGIC, len(dictionary)) + dictionary)
    packer = zstandard.ZstdCompressor(
        level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=True
    )
    for r in records:
        out.write(packer.compress(r))


def read_archive(stream, piece: int = 1 << 16) -> Iterator[bytes]:
    """Records of an archive one after the other."""
    magic, size = struct.unpack("<II", stream.read(8))
    if magic != MAGIC:
        raise ValueError("the archive does not start with its dictionary")
    unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(stream.read(size)))
    frame, parts, fed = unpacker.decompressobj(), [], False
    while data := stream.read(piece):
        while data:
            parts.append(frame.decompress(data))
            fed, data = True, b""
            if frame.eof:
                yield b"".join(parts)
                data, parts, fed, frame = frame.unused_data, [], False, unpacker.decompressobj()
    if fed:
        raise ValueError("the archive ends inside a record")


def with_originals(pages: DataFrame, id_col: str, url_col: str, text_col: str, least: int) -> DataFrame:
    """(page, url, payload, original, revisit) of every page."""
    payload = utf8(text_col)
    source = pages.select(
        F.col(id_col).cast("long").alias("page"),
        F.col(url_col).cast("string").alias("url"),
        payload.alias("payload"),
        F.sha1(payload).alias("digest"),
        F.octet_length(payload).alias("size"),
    )
    # Only payloads that occur twice matter; their table is written, so its size is known to the planner.
    shared = (
        source.where(F.col("size") >= least)
        .groupBy(F.col("digest").alias("d"), F.col("size").alias("s"))
        .agg(F.max("page").alias("original"), F.count("*").alias("n"))
        .where("n > 1")
        .select("d", "s", "original")
    )
    shared = staged(shared, "shared-payloads")
    joined = source.join(shared, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    revisit = F.col("d").isNotNull() & ~F.col("page").eqNullSafe(F.col("original"))
    return joined.select("page", "url", "payload", "original", revisit.alias("revisit"))


def write_archives(
    pages: DataFrame,
    out_dir: str,
    id_col: str = "page_id",
    url_col: str = "url",
    text_col: str = "html",
    least: int = 0,
    date: str = DATE,
) -> DataFrame:
    """Write archives to ``out_dir`` and return the manifest (path, records)."""
    source = with_originals(pages, id_col, url_col, text_col, least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = storage.at(out_dir)
        part, held, size = TaskContext.get().partitionId(), [], 0

        def close() -> pa.RecordBatch:
            system.create_dir(folder, recursive=True)
            path = f"{folder}/{part:06d}-{uuid.uuid4().hex}.warc.zst"
            with system.open_output_stream(path) as out:
                write_archive(out, held)
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([len(held)])], ["path", "records"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                page, url, payload, original, revisit = row
                held.append(make_record(page, url, payload, original, revisit, date))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    return staged(source.mapInArrow(run, "path string, records long"), "archives")


def read_archives(manifest: DataFrame, out_dir: str, with_payload: bool = False) -> DataFrame:
    """One row per record; with the address and the payload (NULL for revisits) if asked for."""
    fields = [
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()),
    ]
    shape = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    if with_payload:
        fields += [("url", pa.string()), ("payload", pa.binary())]
        shape += ", url string, payload binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, _ = storage.at(out_dir)

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in fields], [n for n, _ in fields])

        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                with system.open_input_stream(path) as stream:
                    for record in read_archive(stream):
                        rows.append(parse_record(record))
                        if len(rows) == 500:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    return manifest.select("path").repartition("path").mapInArrow(run, shape)


def op6_warc_archives(spark, sf_dir: str) -> DataFrame:
    """Every page as its record says after writing and reading back."""
    out_dir = shared_dir(prepare(spark), "warc")
    manifest = write_archives(table(spark, sf_dir, "pages"), out_dir)
    return read_archives(manifest, out_dir)
