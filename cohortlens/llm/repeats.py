"""Removal of long repeated substrings by longest-previous-factor arrays.

A byte goes if it lies in a string of ``length`` bytes that starts at another
place too. A suffix array of the whole corpus would sort every position; here
only suffixes that can have such a match are sorted, and each sort is local:

1. *Anchors.* In every string of ``length`` bytes the ``key``-byte window with
   the smallest hash (40 bits; the first of equals) is its anchor. Equal strings have
   their anchor at the same place, so a repeated string has an anchor whose key
   occurs again.
2. *Contexts.* All strings that belong to an anchor lie in the bytes around it
   (``length - key`` before, ``length`` from it on). Anchors with equal keys
   and equal contexts (by a 64-bit hash) form a class. Each member of a class of
   several is covered by matches from end to end; one stands for them below.
3. *Longest previous factors.* For keys with several classes, one context of each
   class is fetched. In its task, the suffixes after a key are sorted, and so are the
   reversed prefixes before it; neighbours in the two orders give the common
   prefixes. Strings that begin ``s`` bytes before the key agree in ``length`` bytes if
   they lie in one run of both orders, that is, of the order of these suffixes cut
   where neighbours share less. Within a run, the previous and the next smaller
   position in suffix order (:func:`smaller_neighbours`) are where an earlier match
   begins: the longest previous factor reaches ``length`` if there is either. The
   previous and next greater positions give a later match in the same way.
4. A key with more than ``HOT_CLASSES`` classes isn't sorted in one task: its
   strings are dealt out one by one by their hash, and counted map-side. This
   replaces the arrays for such keys; results are the same (tests compare them).

Nothing is capped. Places are ordered by document id, text hash and offset.
Classes and strings that hold more than a thousandth of all rows are at most a
thousand; they go to the rows as a broadcast, the others meet by a shuffle."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_BYTES, slices, stored, utf8
from .words import mix, prefix_sums, span_hashes

#: Bytes of a repeated string, and of an anchor's key.
LENGTH, KEY = 400, 200
#: Classes of a key that one task sorts together, and the bytes of contexts
#: that a task ranks at once (whole keys).
HOT_CLASSES, RANK_BYTES = 4096, 1 << 20
#: Bits of a window's hash and of its place in a stretch, which make one number; and
#: of how many rows a group is hot.
PLACE_BITS, HOT_SHARE = 24, 1000

_PLACE = "doc_id long, text_hash long"


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every run of ``width``."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, 1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(after[:n - width + 1], before[width - 1:n])


def anchors(buf: np.ndarray, offsets: np.ndarray, length: int, key: int):
    """(row, place in the row, key hash, context hash, context begin, context
    end) of the anchors of rows."""
    width = length - key + 1
    empty = [np.zeros(0, np.int64)] * 6
    if len(buf) < length:
        return empty
    sums = prefix_sums(buf)
    start = np.arange(len(buf) - key + 1)
    h = span_hashes(sums, start, start + key)
    bits, found = np.uint64(PLACE_BITS), []
    # stretches overlap by a string less a byte, so that each string is in one
    stretch = (1 << PLACE_BITS) - width
    for first in range(0, len(h), stretch):
        part = h[first:first + stretch + width - 1]
        least = window_minima((part >> bits << bits) | np.arange(len(part), dtype=np.uint64), width)
        begin = first + np.arange(len(least))
        row = np.searchsorted(offsets, begin, "right") - 1
        found.append(first + (least[begin + length <= offsets[row + 1]] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64))
    at = np.unique(np.concatenate(found))
    if not len(at):
        return empty
    row = np.searchsorted(offsets, at, "right") - 1
    begin, end = np.maximum(at - (length - key), offsets[row]), np.minimum(at + length, offsets[row + 1])
    context = mix(span_hashes(sums, begin, end) + (at - begin).astype(np.uint64))
    first = offsets[row]
    return row, at - first, h[at].view(np.int64), context.view(np.int64), begin - first, end - first


def _anchor_rows(docs: DataFrame, length: int, key: int) -> DataFrame:
    def run(batches):
        for b in batches:
            buf, offsets = utf8(b.column("text"))
            for first, last in slices(offsets):
                found = anchors(buf[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first], length, key)
                rows = pa.array(found[0] + first)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(rows), b.column("text_hash").take(rows),
                     *(pa.array(c) for c in (found[1].astype(np.int32), found[2], found[3], found[4].astype(np.int32), found[5].astype(np.int32)))],
                    ["doc_id", "text_hash", "at", "key", "context", "begin", "end"])

    return docs.mapInArrow(run, f"{_PLACE}, at int, key long, context long, begin int, end int")


def sorted_prefixes(rows: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of byte rows by group and content, and each one's common prefix
    with the row before it (-1 where the group begins)."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    order = np.lexsort((*padded.view(">u8").astype(np.uint64).T[::-1], group))
    differs = rows[order][1:] != rows[order][:-1]
    common = np.where(differs.any(1), differs.argmax(1), width)
    common[group[order][1:] != group[order][:-1]] = -1
    return order, np.concatenate([[-1], common])


def _reach(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Longest common prefix of each row with any other of its group."""
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(common, np.append(common[1:], -1))
    return out


def smaller_neighbours(values: np.ndarray, run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place, where the previous and the next smaller value of its run are
    (-1 without any). Runs are stretches of equal ``run``.

    As on a stack, a place whose value isn't smaller leads on to its own smaller
    neighbour; all places take that step together."""
    def previous(values, run):
        n = len(values)
        at = np.arange(-1, n - 1)
        at[at >= 0] = np.where(run[at[at >= 0]] == run[1:], at[at >= 0], -1)
        while True:
            open_ = np.flatnonzero(at >= 0)
            open_ = open_[values[at[open_]] >= values[open_]]
            if not len(open_):
                return at
            at[open_] = at[at[open_]]

    before = previous(values, run)
    after = previous(values[::-1], run[::-1])[::-1]
    return before, np.where(after < 0, -1, len(values) - 1 - after)


def factor_matches(before: np.ndarray, after: np.ndarray, left: np.ndarray, right: np.ndarray, group: np.ndarray,
                   place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each distance ``s`` before the key and each context: whether the string
    that begins there has an equal one at an earlier place, and at a later one.

    ``before`` are the bytes left of the keys, nearest first, ``after`` those right
    of them, of which ``left`` and ``right`` are real. Contexts come ordered by place."""
    n, span = before.shape
    (order_b, common_b), (order_a, common_a) = sorted_prefixes(before, group), sorted_prefixes(after, group)
    hopeful = _reach(order_b, common_b) + _reach(order_a, common_a) >= span
    earlier, later = np.zeros((span + 1, n), bool), np.zeros((span + 1, n), bool)
    run_b, run_a = np.empty(n, np.int64), np.empty(n, np.int64)
    rank = np.empty(n, np.int64)
    rank[order_a] = np.arange(n)
    for s in range(span + 1):
        rows = np.flatnonzero(hopeful & (left >= s) & (right >= span - s))
        if len(rows) < 2:
            continue
        run_b[order_b] = np.cumsum(common_b < s)
        run_a[order_a] = np.cumsum(common_a < span - s)
        run = run_b[rows] * (n + 1) + run_a[rows]
        # the suffixes that begin here, in order, as far as they may share a run
        order = np.lexsort((rank[rows], run))
        run, at, p = run[order], rows[order], place[rows[order]]
        smaller, greater = smaller_neighbours(p, run), smaller_neighbours(-p, run)
        earlier[s, at] = (smaller[0] >= 0) | (smaller[1] >= 0)
        later[s, at] = (greater[0] >= 0) | (greater[1] >= 0)
    return earlier, later


def _spans(table: pa.Table, length: int, key: int, keep_first: bool) -> pa.RecordBatch:
    """Covered spans of the contexts of whole keys."""
    doc = np.unique(np.stack([table.column("doc_id").fill_null(-1 << 63).to_numpy(), table.column("text_hash").to_numpy()], 1),
                    axis=0, return_inverse=True)[1].ravel()
    place = doc.astype(np.int64) << 32 | table.column("at").to_numpy()
    table = table.take(pa.array(np.argsort(place, kind="stable")))
    place = np.sort(place, kind="stable")
    buf, offsets = utf8(table.column("bytes"))
    left = table.column("left").to_numpy().astype(np.int64)
    right = np.diff(offsets) - left
    column, middle = np.arange(length - key), (offsets[:-1] + left)[:, None]
    buf = np.append(buf, np.uint8(0))
    before = np.where(column < left[:, None], buf[np.maximum(middle - 1 - column, 0)], 0).astype(np.uint8)
    after = np.where(column < right[:, None], buf[np.minimum(middle + column, len(buf) - 1)], 0).astype(np.uint8)
    group = np.unique(table.column("key").to_numpy(), return_inverse=True)[1]
    earlier, later = factor_matches(before, after, left, right, group, place)
    distance, rows = np.nonzero(earlier if keep_first else earlier | later)
    begin = table.column("at").to_numpy().astype(np.int64)[rows] - distance
    order = np.lexsort((begin, rows))
    rows, begin = rows[order], begin[order]
    # strings of one context that overlap or touch make one span
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (begin[1:] > begin[:-1] + length)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(rows)) - 1 if len(rows) else first
    at = pa.array(rows[first])
    return pa.RecordBatch.from_arrays(
        [table.column("doc_id").combine_chunks().take(at), table.column("text_hash").combine_chunks().take(at),
         pa.array(begin[first].astype(np.int32)), pa.array((begin[last] + length).astype(np.int32))], ["doc_id", "text_hash", "begin", "end"])


def _sorted_spans(contexts: DataFrame, length: int, key: int, keep_first: bool) -> DataFrame:
    """Spans from contexts dealt out and ordered by key."""
    def run(batches):
        held, size = [], 0
        for b in batches:
            if b.num_rows == 0:
                continue
            held.append(b)
            size += b.column("bytes").nbytes
            if size < RANK_BYTES:
                continue
            table = pa.Table.from_batches(held)
            keys = table.column("key").to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on in the next batch
            if cut:
                yield _spans(table.slice(0, cut), length, key, keep_first)
                held = table.slice(cut).combine_chunks().to_batches()
                size = sum(x.column("bytes").nbytes for x in held)
        if held:
            yield _spans(pa.Table.from_batches(held), length, key, keep_first)

    return contexts.repartition("key").sortWithinPartitions("key").mapInArrow(run, f"{_PLACE}, begin int, end int")


def _fetched(docs: DataFrame, reps: DataFrame, key_bytes: int) -> DataFrame:
    """What lies around the keys: ``key, doc_id, text_hash, at, left, bytes`` (the
    bytes before the key, ``left`` of them, and those after it)."""
    by_doc = reps.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("key", "at", "begin", "end")).alias("wanted"))
    same = docs["doc_id"].eqNullSafe(by_doc["doc_id"]) & (docs["text_hash"] == by_doc["text_hash"])
    # rows that repeat id and text fetch a context twice; it is at one place, which counts once
    joined = docs.join(by_doc, same).select(docs["doc_id"], docs["text_hash"], "text", "wanted")

    def run(batches):
        for b in batches:
            buf, offsets = utf8(b.column("text"))
            wanted = b.column("wanted")
            row = np.repeat(np.arange(b.num_rows), np.diff(wanted.offsets.to_numpy()))
            key, at, begin, end = (wanted.flatten().field(k) for k in range(4))
            cut = [(offsets[row] + x.to_numpy()) for x in (begin, at, end)]
            left = (at.to_numpy() - begin.to_numpy()).astype(np.int32)
            for i in range(0, len(row), 2000):
                part = slice(i, i + 2000)
                data = [buf[x:y].tobytes() + buf[y + key_bytes:z].tobytes() for x, y, z in zip(*(c[part].tolist() for c in cut), strict=True)]
                of = pa.array(row[part])
                yield pa.RecordBatch.from_arrays(
                    [key.slice(i, len(data)), b.column("doc_id").take(of), b.column("text_hash").take(of), at.slice(i, len(data)),
                     pa.array(left[part]), pa.array(data, pa.binary())], ["key", "doc_id", "text_hash", "at", "left", "bytes"])

    return joined.mapInArrow(run, f"key long, {_PLACE}, at int, left int, bytes binary")


def _met(rows: DataFrame, groups: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows`` with what ``groups(keys, n, ...)`` has for them. Groups that hold more
    than a thousandth of the ``total`` rows are a thousand at most: a broadcast."""
    hot = groups.where(F.col("n") * HOT_SHARE > total)
    if hot.isEmpty():
        return rows.join(groups, keys)
    many = F.broadcast(hot.select(*keys))
    return rows.join(F.broadcast(hot), keys).unionByName(
        rows.join(many, keys, "left_anti").join(groups.where(F.col("n") * HOT_SHARE <= total), keys))


def _counted_spans(contexts: DataFrame, length: int, key: int, keep_first: bool) -> DataFrame:
    """Spans of keys with very many classes: every string by its hash."""
    around = length - key

    def run(batches):
        for b in batches:
            buf, offsets = utf8(b.column("bytes"))
            for first, last in slices(offsets, SLICE_BYTES // 4):
                part, cuts = buf[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
                n = np.maximum(np.diff(cuts) - around + 1, 0)
                owner = np.repeat(np.arange(len(n)), n)
                within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                # what is on either side of the key, and how much of it is to the left
                distance = b.column("left").to_numpy()[owner + first] - within
                start = cuts[owner] + within
                h = mix(span_hashes(prefix_sums(part), start, start + around) + distance.astype(np.uint64))
                inside = distance >= 0
                at = pa.array((owner + first)[inside])
                begin = (b.column("at").to_numpy()[owner + first] - distance)[inside]
                yield pa.RecordBatch.from_arrays(
                    [b.column("key").take(at), pa.array(h[inside].view(np.int64)), b.column("doc_id").take(at), b.column("text_hash").take(at),
                     pa.array(begin.astype(np.int32))], ["key", "suffix", "doc_id", "text_hash", "begin"])

    rows = stored(contexts.mapInArrow(run, f"key long, suffix long, {_PLACE}, begin int"), "hot-suffixes")
    place = F.struct("doc_id", "text_hash", "begin")
    runs = (rows.groupBy("key", "suffix").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n"))
            .where("first.doc_id IS DISTINCT FROM last.doc_id OR first.text_hash <> last.text_hash OR first.begin <> last.begin"))
    hits = _met(rows, stored(runs, "hot-runs"), ["key", "suffix"], rows.count())
    if keep_first:
        hits = hits.where(~place.eqNullSafe(F.col("first")))
    return hits.select("doc_id", "text_hash", "begin", (F.col("begin") + length).cast("int").alias("end"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, key: int = KEY, keep_first: bool = False,
                   hot_classes: int = HOT_CLASSES) -> DataFrame:
    """Spans ``doc_id, text_hash, begin, end`` (bytes, may overlap) of ``docs(doc_id,
    text_hash, text)`` that repeated strings cover."""
    found = stored(_anchor_rows(docs, length, key), "anchors")
    place = F.struct("doc_id", "text_hash", "at", "begin", "end")
    classes = found.groupBy("key", "context").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    classes = stored(classes, "classes")
    keys = stored(classes.groupBy("key").agg(F.count(F.lit(1)).alias("classes")).where("classes > 1"), "repeated-keys")
    open_keys = stored(classes.join(keys, "key").select("key", "classes", "first.*"), "open-keys")

    covered = _met(found, classes.where("n > 1").select("key", "context", "n", "first"), ["key", "context"], found.count())
    if keep_first:
        covered = covered.where(~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
                                  & (F.col("at") == F.col("first.at"))))
    spans = covered.select("doc_id", "text_hash", "begin", "end")
    contexts = stored(_fetched(docs, open_keys.select("key", "doc_id", "text_hash", "at", "begin", "end"), key), "contexts")
    hot = open_keys.where(F.col("classes") > hot_classes).select("key").distinct()
    if hot.isEmpty():
        return spans.unionByName(_sorted_spans(contexts, length, key, keep_first))
    return (spans.unionByName(_sorted_spans(contexts.join(hot, "key", "left_anti"), length, key, keep_first))
            .unionByName(_counted_spans(contexts.join(hot, "key", "left_semi"), length, key, keep_first)))


def merged(begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs that the spans cover; spans that touch make one run."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(zip(begin.tolist(), end.tolist(), strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                    key: int = KEY, keep_first: bool = False, hot_classes: int = HOT_CLASSES) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, removed, kept``.

    ``removed`` are the maximal runs [begin, end) of bytes taken out, ``kept`` the
    bytes that stay. With ``keep_first``, the first of several equal strings
    stays (the longest previous factor decides); else all go. Matches never
    cross documents. Null is empty; texts shorter than ``length`` stay whole;
    rows that repeat id and text repeat each other and are judged alike; an
    empty table gives an empty result."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"")).alias("text"))
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    spans = stored(repeated_spans(docs, length, key, keep_first, hot_classes), "spans")
    # a row repeated often has its spans once
    by_doc = spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("begin", "end")).alias("spans")).select(
        "doc_id", "text_hash", F.col("spans.begin").alias("begin"), F.col("spans.end").alias("end"))
    same = docs["doc_id"].eqNullSafe(by_doc["doc_id"]) & (docs["text_hash"] == by_doc["text_hash"])
    joined = docs.join(by_doc, same, "left").select(docs["doc_id"], "text", "begin", "end")
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            sizes, removed, kept = [], [], []
            for text, begin, end in zip(b.column("text"), b.column("begin"), b.column("end"), strict=True):
                data = text.as_py()
                runs = merged(begin.values.to_numpy(), end.values.to_numpy()) if begin.is_valid else []
                edges = [0, *(x for r in runs for x in r), len(data)]
                sizes.append(len(data))
                removed.append([{"begin": a, "end": z} for a, z in runs])
                kept.append(b"".join(data[edges[k]:edges[k + 1]] for k in range(0, len(edges), 2)) if runs else data)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, span), pa.array(kept, pa.binary())],
                                             ["doc_id", "n_bytes", "removed", "kept"])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, removed array<struct<begin:int,end:int>>, kept binary")


def brute_force(texts: list[bytes], length: int) -> list[tuple[list[tuple[int, int]], str]]:
    """Removed runs and digest of what is kept, from a table of all strings."""
    places: dict[bytes, int] = {}
    for t in texts:
        for k in range(len(t) - length + 1):
            places[t[k:k + length]] = places.get(t[k:k + length], 0) + 1
    out = []
    for t in texts:
        hits = np.array([k for k in range(len(t) - length + 1) if places[t[k:k + length]] > 1], int)
        runs = merged(hits, hits + length)
        edges = [0, *(x for r in runs for x in r), len(t)]
        out.append((runs, hashlib.sha256(b"".join(t[edges[k]:edges[k + 1]] for k in range(0, len(edges), 2))).hexdigest()))
    return out
