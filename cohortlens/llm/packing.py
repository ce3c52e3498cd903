"""Best-fit packing of documents into sequences by hierarchical rounds.

1. Every text becomes token ids and an end id; a document longer than a
   sequence is cut, the rest of it first and full pieces after.
2. Each partition packs its pieces by best fit, longest first. Bins with
   hardly any room left are done.
3. The other bins become items, as long as they are filled; a few partitions
   at a time merge and pack them again. Bins with less room than the smallest of
   them holds can't be joined any more and are done. Partitions become fewer until
   each has about ``ROUND_ITEMS`` bins, and rounds end when one has brought together
   hardly any (a thousandth), or there is one partition.

What moves between tasks is 29 bytes a piece. However many bins remain, a task of a
round is for about ``ROUND_ITEMS`` of them; the first round takes its partition in
runs of that many."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import stored

SEQUENCE = 2048
END_ID = 0
#: Room (tokens) with which a bin counts as full, partitions merged into one by
#: each round, and items that a task packs at once.
NEARLY_FULL, FAN_IN, ROUND_ITEMS = 4, 8, 1 << 19
#: The share of bins that a round over as many partitions must bring together for another.
LEAST_GAIN = 0.001

PIECE = np.dtype([("doc", "<i8"), ("known", "u1"), ("piece", "<i4"), ("start", "<i8"), ("length", "<i4"), ("crc", "<u4")])
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cuts(n: int, limit: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    first = n % limit or min(n, limit)
    yield 0, first
    for start in range(first, n, limit):
        yield start, limit


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = SEQUENCE,
           end_id: int = END_ID, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32``. A null or
    empty text is the end id alone."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        for b in batches:
            out = []
            for doc, ids in zip(b.column(0).to_pylist(), tokens.encoded(b.column(1).to_pylist(), vocabulary), strict=True):
                ids += end
                out += [(doc, k, start, n, zlib.crc32(ids[4 * start:4 * (start + n)]))
                        for k, (start, n) in enumerate(cuts(len(ids) // 4, limit))]
            if out:
                columns = list(zip(*out, strict=True))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                                 ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, _PIECES)


def best_fit(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, int]:
    """The bin of each size, best fit with the longest first, and the number
    of bins. Open bins are kept by their room; a bit per room finds the
    tightest one that fits."""
    bins = np.empty(len(sizes), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms, n = 0, 0
    for k in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[k])
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            chosen = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, chosen = limit, n
            n += 1
        bins[k] = chosen
        left = room - size
        if left:
            if not open_bins[left]:
                rooms |= 1 << left
            open_bins[left].append(chosen)
    return bins, n


def _pack(sizes: np.ndarray, members: list[bytes], limit: int, nearly_full: int) -> pa.RecordBatch:
    """Bins of the items: ``fill, members, full``."""
    bins, n = best_fit(sizes, limit)
    fills = np.bincount(bins, sizes, n).astype(np.int64)
    parts: list[list[bytes]] = [[] for _ in range(n)]
    for k, at in enumerate(bins.tolist()):
        parts[at].append(members[k])
    return pa.RecordBatch.from_arrays(
        [pa.array(fills, pa.int32()), pa.array([b"".join(p) for p in parts], pa.binary()), pa.array(fills >= limit - nearly_full)],
        ["fill", "members", "full"])


def _piece_members(b: pa.RecordBatch) -> tuple[np.ndarray, list[bytes]]:
    rows = np.empty(b.num_rows, PIECE)
    doc = b.column("doc_id")
    rows["known"] = np.asarray(doc.is_valid())
    rows["doc"] = doc.fill_null(0).to_numpy(zero_copy_only=False)
    for name, column in (("piece", "piece"), ("start", "start"), ("length", "length"), ("crc", "ids_crc32")):
        rows[name] = b.column(column).to_numpy(zero_copy_only=False)
    raw, n = rows.tobytes(), PIECE.itemsize
    return rows["length"].astype(np.int64), [raw[k:k + n] for k in range(0, len(raw), n)]


def _bin_members(b: pa.RecordBatch) -> tuple[np.ndarray, list[bytes]]:
    return b.column("fill").to_numpy(zero_copy_only=False).astype(np.int64), b.column("members").to_pylist()


def _round(items: DataFrame, load, limit: int, nearly_full: int) -> DataFrame:
    def pack(batches):
        sizes, members, held = [], [], 0
        for b in batches:
            s, m = load(b)
            sizes.append(s)
            members += m
            held += len(m)
            if held >= ROUND_ITEMS:
                yield _pack(np.concatenate(sizes), members, limit, nearly_full)
                sizes, members, held = [], [], 0
        if held:
            yield _pack(np.concatenate(sizes), members, limit, nearly_full)

    return stored(items.mapInArrow(pack, "fill int, members binary, full boolean"), "packing-round")


def sequences(items: DataFrame, limit: int = SEQUENCE, nearly_full: int = NEARLY_FULL,
              fan_in: int = FAN_IN, round_items: int = ROUND_ITEMS) -> DataFrame:
    """Pack the rows of :func:`pieces`; adds ``sequence_id, offset`` to each.

    Lengths are 1 to ``limit``. Repeated rows are packed each for itself; no
    rows give no sequences."""
    items = stored(items, "packing-pieces")
    n = max(1, items.select(F.spark_partition_id()).distinct().count())
    bins = _round(items, _piece_members, limit, nearly_full)
    done, rest = [bins.where("full")], bins.where("not full")
    last = None
    while n > 1:
        left = rest.agg(F.count(F.lit(1)).alias("n"), F.min("fill").alias("least")).first()
        if left["n"] < 2 or last is not None and left["n"] > last * (1 - LEAST_GAIN):
            break
        # no other bin fits into what has less room than the smallest one holds
        fits = F.col("fill") + left["least"] <= limit
        done.append(rest.where(~fits))
        fewer, last = max(-(-n // fan_in), -(-left["n"] // round_items)), left["n"] if n <= -(-left["n"] // round_items) else None
        n = min(n, fewer)
        bins = _round(rest.where(fits).repartition(n), _bin_members, limit, nearly_full)
        done.append(bins.where("full"))
        rest = bins.where("not full")
    for more in done:
        rest = rest.unionByName(more)
    rest = stored(rest.select("members"), "packing-bins")  # the numbers below stay the same on a second read

    def rows(batches):
        for b in batches:
            members = b.column("members").to_pylist()
            a = np.frombuffer(b"".join(members), PIECE)
            counts = np.array([len(m) // PIECE.itemsize for m in members])
            ends = np.cumsum(a["length"].astype(np.int64))
            first = np.repeat(np.cumsum(counts) - counts, counts)
            starts = ends - a["length"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(a["doc"], mask=a["known"] == 0), pa.array(a["piece"]), pa.array(a["start"]),
                 pa.array(a["length"].astype(np.int64)), pa.array(a["crc"].astype(np.int64)),
                 pa.array(np.repeat(b.column("sequence_id").to_numpy(), counts)), pa.array(starts - starts[first])],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return (rest.withColumn("sequence_id", F.monotonically_increasing_id())
            .mapInArrow(rows, f"{_PIECES}, sequence_id long, offset long"))


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Tokenise, cut and pack ``docs`` (see :func:`pieces`, :func:`sequences`)."""
    return sequences(pieces(docs, **options))
