"""Web archives (WARC/1.1) with a Zstandard dictionary in each file.

Each archive file begins with a skippable frame (magic 0x184D2A5D) that holds
the file's dictionary, trained on the first records written to it; every
record follows as a frame of its own, so that one record is read by its offset
and the dictionary alone.

Payloads that repeat are archived once: of records with equal payloads of at
least ``min_bytes`` bytes the one with the smallest id is a response, the
others are revisits that name it. Which, is decided by Spark over digests."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from itertools import batched

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import files
from .common import scratch, stored

#: Fixed value of the format: the magic number of the dictionary's frame.
SKIPPABLE_MAGIC = 0x184D2A5D
#: Payloads shorter than this are always stored.
MIN_REVISIT_BYTES = 100
#: Dictionary size, and the bytes of records that a task holds to train it.
DICTIONARY_BYTES, TRAINING_BYTES, LEVEL = 32 << 10, 1 << 20, 3
#: Records that are read at once.
READ_ROWS = 2000
DATE = "2001-01-01T00:00:00Z"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_id(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record: a response, or a revisit if ``refers_to`` is given."""
    block = b"" if refers_to is not None else _HTTP % len(payload) + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {_REVISIT_PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode("utf-8") + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"not a record: {version[:40]}")
    fields = dict(line.split(": ", 1) for line in lines)
    n = int(fields["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    return fields, rest[:n]


def _page(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def with_roles(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, payload, digest, refers_to`` (null for a response).

    Digests are grouped without their payloads and counted map-side, so that a
    page that a third of all rows repeat meets in few rows; the payloads are
    dealt out by id, which spreads them."""
    payload = F.coalesce(F.encode(F.col(html_col), "UTF-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                        payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    digests = stored(rows.where(F.octet_length("payload") >= min_bytes).select("page_id", "digest"), "warc-digests")
    copies = (digests.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").drop("n"))
    # one row for each id and payload: a page's id may come with several payloads
    revisits = (digests.distinct().join(copies, "digest").where(~F.col("page_id").eqNullSafe(F.col("first")))
                .select(F.struct("page_id", "digest").alias("copy"), F.col("first").alias("refers_to")))
    return (rows.withColumn("own", F.struct("page_id", "digest")).join(revisits, F.col("own") == F.col("copy"), "left")
            .select("page_id", "url", "payload", "digest", "refers_to"))


def _archive(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Write the rows (page_id, url, payload, digest, refers_to) to one file."""
    held, size, out, packer, path, n = [], 0, None, None, "", 0

    def begin():
        nonlocal out, packer, path
        try:
            data = zstandard.train_dictionary(DICTIONARY_BYTES, held).as_bytes()
        except (zstandard.ZstdError, ValueError, MemoryError):
            data = b"".join(held)[:DICTIONARY_BYTES]  # too few records to train on
        path = files.attempt_name(folder, TaskContext.get().partitionId(), ".warc.zst")
        out = files.create(path)
        out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(data)) + data)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(data), write_content_size=True)
        for r in held:
            out.write(packer.compress(r))
        held.clear()

    try:
        for b in batches:
            for page, url, payload, digest, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = record(page, url, payload, digest, first)
                n += 1
                if out is None:
                    held.append(data)
                    size += len(data)
                    if size >= TRAINING_BYTES:
                        begin()
                else:
                    out.write(packer.compress(data))
        if held:
            begin()
    finally:
        if out is not None:
            out.close()
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n], pa.int64())], ["path", "n_records"])


def write(pages: DataFrame, folder: str, **options) -> DataFrame:
    """Write a record per row below ``folder``; returns the manifest, one row
    per file: ``path, n_records``.

    Null html is an empty payload. Rows that repeat an id and a payload are one
    record met again: each is archived as that record is. Of equal payloads
    whose ids are all null, none refers to another. An empty table writes no
    file; further columns are ignored. ``options`` are those of
    :func:`with_roles`."""
    return stored(with_roles(pages, **options).mapInArrow(lambda batches: _archive(batches, folder),
                                                         "path string, n_records long"), "warc-manifest")


def frames(source, unpacker: zstandard.ZstdDecompressor) -> Iterator[bytes]:
    """Contents of the frames that follow, one at a time."""
    pending = source.read(1 << 16)
    while pending:
        frame, data = unpacker.decompressobj(), []
        while not frame.eof:
            if not pending:
                raise ValueError("the archive ends within a record")
            data.append(frame.decompress(pending))
            pending = frame.unused_data if frame.eof else source.read(1 << 16)
        yield b"".join(data)
        pending = pending or source.read(1 << 16)


def records(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of an archive, one at a time."""
    with files.open_stream(path) as source:
        magic, n = struct.unpack("<II", source.read(8))
        if magic != SKIPPABLE_MAGIC:
            raise ValueError("the archive has no dictionary frame")
        dictionary = zstandard.ZstdCompressionDict(source.read(n))
        for data in frames(source, zstandard.ZstdDecompressor(dict_data=dictionary)):
            yield parse(data)


def read(manifest: DataFrame) -> DataFrame:
    """One row per record, from the archives alone: ``page_id, url, payload_bytes,
    payload_digest, record_type, refers_to``. A response's digest and length
    are checked against its payload."""
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(),
             "record_type": pa.string(), "refers_to": pa.int64()}

    def rows(path):
        for fields, block in records(path):
            n, digest = int(fields["WARC-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
            kind = fields["WARC-Type"]
            if kind == "response":
                payload = block.partition(b"\r\n\r\n")[2]
                if len(payload) != n or hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"damaged record {fields['WARC-Record-ID']} in {path}")
            refers = fields.get("WARC-Refers-To")
            yield (_page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), n, digest, kind,
                   None if refers is None else _page(refers))

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                for part in batched(rows(path), READ_ROWS):
                    columns = zip(*part, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)],
                                                     list(kinds))

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.repartition(n).mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, "
                                                   "record_type string, refers_to long")


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` below the shared folder and read the archives back."""
    return read(write(pages, scratch(pages.sparkSession, "warc"), **options))
