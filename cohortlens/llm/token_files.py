"""Token ids in binary files, each document compressed on its own.

A data set is a folder with one dictionary, ``dictionary.zstd``, and files in
ascending document order:

    magic (8 bytes) | SHA-256 of the dictionary (32 bytes)
    one Zstandard frame per document: its ids as little-endian uint32
    index: per document id (int64), has-id flag (uint8), end offset (uint64),
           number of ids (uint32), as four arrays
    trailer: number of documents, offset of the index (uint64 each), magic

The dictionary is trained on serialised id arrays of a bounded sample, so that
short documents compress well and any one of them can be read by two seeks.
Sampling touches nothing but the size of the files."""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import files, tokens
from .common import scratch, stored

MAGIC = b"TOKIDS\x00\x01"
#: The dictionary: its size, the documents it is trained on, and the bytes of
#: ids taken of each (a sample of a sample: the files hold every id).
DICTIONARY_BYTES, SAMPLE_DOCS, SAMPLE_BYTES = 64 << 10, 800, 16 << 10
LEVEL = 3
#: Bytes of text for a file, and documents that are read at once.
FILE_BYTES, READ_DOCS = 12 << 20, 2000


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the samples; their plain bytes where there are too few
    to train on, and nothing without samples."""
    samples = [s for s in samples if s]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except (zstandard.ZstdError, ValueError, MemoryError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def _sampled(docs: DataFrame, n: int, vocabulary: str) -> list[bytes]:
    """Serialised ids of the beginnings of about SAMPLE_DOCS of the ``n`` documents,
    spread over the table."""
    share = min(1.0, SAMPLE_DOCS / max(n, 1))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)

    def heads(batches):
        for b in batches:
            ids = [x[:SAMPLE_BYTES] for x in tokens.encoded(b.column("text").to_pylist(), vocabulary)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], ["ids"])

    # an id is a byte or more: no more of a text than may be kept of it
    rows = chosen.limit(4 * SAMPLE_DOCS).select(F.substring("text", 1, 4 * SAMPLE_BYTES).alias("text")).mapInArrow(heads, "ids binary")
    return sorted(bytes(r.ids) for r in rows.collect())


def write(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
          end_id: int | None = 2, vocabulary: str = tokens.VOCABULARY, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the data set and return its manifest, one row per file:
    ``part, path, n_docs, n_tokens`` (parts ascend with the ids).

    Null ids come first; rows with equal ids follow each other by the hash of
    their text; a null text has the end id alone. An empty table writes only
    the dictionary. Further columns are ignored. A file is for about ``file_bytes``
    bytes of text, however many rows share an id or are alike."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    dictionary = train_dictionary(_sampled(docs, size["n"], vocabulary))
    with files.create(f"{folder}/dictionary.zstd") as out:
        out.write(dictionary)
    end = np.array([] if end_id is None else [end_id], "<u4").tobytes()

    def write_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path = None, ""
        shared = _dictionary(dictionary)
        packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared) if shared else zstandard.ZstdCompressor(level=LEVEL)
        ids, known, ends, counts, at = [], [], [], array("L"), 0
        try:
            for b in batches:
                if b.num_rows == 0:
                    continue
                if out is None:
                    part = TaskContext.get().partitionId()
                    path = files.attempt_name(folder, part, ".ids")
                    out = files.create(path)
                    at = out.write(MAGIC + hashlib.sha256(dictionary).digest())
                sizes = np.empty(b.num_rows, np.uint64)
                for k, x in enumerate(tokens.encoded(b.column("text").to_pylist(), vocabulary)):
                    frame = packer.compress(x + end)
                    out.write(frame)
                    at += len(frame)
                    sizes[k] = at
                    counts.append((len(x) + len(end)) // 4)
                ends.append(sizes)
                ids.append(b.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype("<i8"))
                known.append(np.asarray(b.column("doc_id").is_valid()).astype("u1"))
            if out is None:
                return
            for column, kind in ((np.concatenate(ids), "<i8"), (np.concatenate(known), "u1"),
                                 (np.concatenate(ends), "<u8"), (np.array(counts), "<u4")):
                out.write(column.astype(kind).tobytes())
            out.write(np.array([len(counts), at], "<u8").tobytes() + MAGIC)
        finally:
            if out is not None:
                out.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([path]), pa.array([len(counts)], pa.int64()),
             pa.array([sum(counts)], pa.int64())], ["part", "path", "n_docs", "n_tokens"])

    # the text's hash, and then the row's number, spread what many rows share over several files
    order = [F.col("doc_id"), F.xxhash64("text"), F.col("_row")]
    parts = max(1, -(-(size["bytes"] or 0) // file_bytes))
    return stored(docs.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
                  .sortWithinPartitions(*order).select("doc_id", "text")
                  .mapInArrow(write_part, "part int, path string, n_docs long, n_tokens long"), "token-manifest")


def read_index(source) -> tuple[bytes, list[np.ndarray]]:
    """The dictionary's hash and the index arrays of an open file."""
    size = source.size()
    source.seek(size - 24)
    n, at = map(int, np.frombuffer(source.read(16), "<u8"))
    if source.read(8) != MAGIC:
        raise ValueError("not a token file")
    source.seek(0)
    head = source.read(40)
    source.seek(at)
    raw = source.read(21 * n)
    cuts = np.cumsum([0, 8 * n, n, 8 * n, 4 * n])
    return head[8:], [np.frombuffer(raw[a:b], k) for a, b, k in zip(cuts, cuts[1:], ("<i8", "u1", "<u8", "<u4"), strict=False)]


def documents(path: str, wanted: set[int] | None = None) -> Iterator[tuple[int | None, bytes]]:
    """(id, serialised ids) of a file's documents, or of the wanted ones only."""
    with files.open_file(path) as source, files.open_stream(f"{path.rpartition('/')[0]}/dictionary.zstd") as d:
        digest, (ids, known, ends, _) = read_index(source)
        dictionary = d.read()
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError("the file was written with another dictionary")
        shared = _dictionary(dictionary)
        unpacker = zstandard.ZstdDecompressor(dict_data=shared) if shared else zstandard.ZstdDecompressor()
        begin = 40
        source.seek(begin)
        for k, end in enumerate(ends.tolist()):
            if wanted is None:
                yield (int(ids[k]) if known[k] else None), unpacker.decompress(source.read(end - begin))
            elif known[k] and int(ids[k]) in wanted:
                source.seek(begin)
                yield int(ids[k]), unpacker.decompress(source.read(end - begin))
            begin = end


def read(manifest: DataFrame) -> DataFrame:
    """One row per document, from the files alone: ``doc_id, start, n_tokens,
    ids_crc32``. ``start`` counts the ids of all documents before it."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    parts = manifest.select("part", "path", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))

    def read_part(batches):
        for b in batches:
            for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist(), strict=True):
                for some in batched(documents(path), READ_DOCS):
                    rows = []
                    for doc, ids in some:
                        rows.append((doc, start, len(ids) // 4, zlib.crc32(ids)))
                        start += len(ids) // 4
                    columns = list(zip(*rows, strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                                     ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(n).mapInArrow(read_part, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` below the shared folder and read the files back."""
    return read(write(docs, scratch(docs.sparkSession, "token-files"), **options))
