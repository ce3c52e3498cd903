"""Near-duplicates by MinHash with tensored banding.

A document's set is its distinct shingles (runs of words). Two collections of
``bands`` small hashes, each made of ``rows`` minhashes, are taken of it; the
key of table (i, j) combines hash i of the first with hash j of the second.
``bands ** 2`` tables thus cost 2 * bands * rows minhashes instead of
2 * bands ** 2 * rows. Documents of similarity s share a table with
probability (1 - (1 - s ** rows) ** bands) ** 2: 0.9994 at 0.8 and 0.999999 at
0.9 with the defaults, and every candidate is confirmed on the full sets.

Groups are never expanded into pairs:

1. Documents with equal sets become one representative.
2. In every bucket of a table, one member (the leader: the one with most
   neighbours in all tables) is compared with the others on the full texts; the
   links found are closed to components.
3. Buckets whose members are still in several components get their members'
   sets and are compared in blocks of at most ``BLOCK`` by ``BLOCK``, within
   tasks and only across components. What leaves a task are pairs whose sets of
   52-bit hashes are similar, which join their components for the rest of the
   block, and pairs just short of it, which don't. All are confirmed on the full
   texts. If one that joined components is turned down there (two shingles had one
   hash), it may have hidden others: then the round is made once more, and no pair
   joins anything in it.

Two documents that share a bucket are therefore in one component, or were
compared and found to differ. What is stored on the way is removed as soon as all
that was made of it is stored."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, slices, split_by_ids, stored, utf8
from .components import components
from .words import SPACED, Words, mix, run_hashes

#: Words of a shingle, hashes of a collection, minhashes of a hash, similarity
#: in hundredths, and members that a task compares with as many others at once.
SHINGLE, BANDS, ROWS, PERCENT, BLOCK = 2, 8, 2, 80, 1024
#: Shared shingles that a comparison by hashes may be short of.
SLACK = 1
#: Bits of a shingle's hash: what 64 bits leave beside the row within a slice.
SLICE_ROWS_BITS = 12

_SEED = np.random.default_rng(20240229)
_MULTIPLY = _SEED.integers(1, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _SEED.integers(0, 1 << 63, 4096, dtype=np.uint64)


def _sets(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash (52 bits) of the distinct shingles, ordered by row. A row of
    fewer words has its whole sequence as one."""
    runs = run_hashes(words.hash, shingle)
    inside = words.row[:len(runs)] == words.row[shingle - 1:] if len(runs) else np.zeros(0, bool)
    rows, hashes = [words.row[:len(runs)][inside]], [runs[inside]]
    for n in range(1, shingle):
        short = np.flatnonzero(words.count == n)
        rows.append(short)
        hashes.append(mix(run_hashes(words.hash, n)[words.first[short]] + np.uint64(n)))
    row, h = np.concatenate(rows), np.concatenate(hashes)
    bits = np.uint64(SLICE_ROWS_BITS)
    key = np.unique((row.astype(np.uint64) << (np.uint64(64) - bits)) | (h >> bits))
    return (key >> (np.uint64(64) - bits)).astype(np.int64), key & np.uint64((1 << (64 - SLICE_ROWS_BITS)) - 1)


def signatures(texts: pa.Array, shingle: int, bands: int, rows: int):
    """Per text: size of its set, two hashes of the set, and its 2 * bands small
    hashes (zeros for an empty set)."""
    buf, offsets = utf8(texts)
    n_docs = len(offsets) - 1
    sizes, sums = np.zeros(n_docs, np.int64), np.zeros((n_docs, 2), np.uint64)
    small = np.zeros((n_docs, 2 * bands), np.uint64)
    for first, last in slices(offsets):
        for a in range(first, last, 1 << SLICE_ROWS_BITS):
            b = min(last, a + (1 << SLICE_ROWS_BITS))
            words = Words(buf[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], SPACED)
            row, h = _sets(words, shingle)
            if not len(row):
                continue
            begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            at = a + row[begin]
            sizes[at] = np.diff(np.append(begin, len(row)))
            for k in range(2):
                sums[at, k] = np.add.reduceat(mix(h ^ _ADD[4000 + k]), begin)
            for k in range(2 * bands):
                band = np.full(len(begin), k, np.uint64)
                for r in range(k * rows, (k + 1) * rows):
                    band = mix(band * np.uint64(31) + np.minimum.reduceat((h * _MULTIPLY[r] + _ADD[r]) >> np.uint64(20), begin))
                small[at, k] = band
    return sizes, sums, small


def _signed(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    def run(batches):
        for b in batches:
            sizes, sums, small = signatures(b.column("text"), shingle, bands, rows)
            longs = lambda a: pa.FixedSizeListArray.from_arrays(pa.array(a.view(np.int64).ravel()), a.shape[1]).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("h"), b.column("h2"), pa.array(sizes), pa.array(sums[:, 0].copy().view(np.int64)), pa.array(sums[:, 1].copy().view(np.int64)),
                 longs(small[:, :bands].copy()), longs(small[:, bands:].copy())],
                ["doc_id", "h", "h2", "n_shingles", "set_a", "set_b", "left", "right"])

    return docs.mapInArrow(run, "doc_id long, h long, h2 long, n_shingles long, set_a long, set_b long, left array<long>, right array<long>")


def _buckets(reps: DataFrame) -> DataFrame:
    """``key, id, size, n`` for every table of every representative, where ``n``
    (the bucket's members) is over 1."""
    keys = F.flatten(F.transform("left", lambda x, i: F.transform(F.col("right"), lambda y, j: F.xxhash64(i, j, x, y))))
    rows = reps.select(F.explode(keys).alias("key"), "id", F.col("n_shingles").alias("size"))
    crowded = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return stored(rows.join(crowded, "key"), "buckets")


def _sizes_allow(x: Column, y: Column, percent: int) -> Column:
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _led(buckets: DataFrame, percent: int) -> DataFrame:
    """Pairs (leader, member) of the buckets."""
    central = buckets.groupBy("id").agg(F.sum("n").alias("neighbours"))
    rows = stored(buckets.select("key", "id", "size").join(central, "id"), "ranked")
    leaders = rows.groupBy("key").agg(F.max(F.struct("neighbours", "id", "size")).alias("lead"))
    pairs = rows.join(leaders, "key").where((F.col("id") != F.col("lead.id")) & _sizes_allow(F.col("size"), F.col("lead.size"), percent))
    return pairs.select(F.col("lead.id").alias("a"), F.col("id").alias("b")).distinct()


def _divided(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows of the buckets whose members are in several components."""
    rows = buckets.join(parts, F.col("id") == F.col("node"), "left").select("key", "id", "size", F.coalesce("component", "id").alias("part"), "n")
    rows = stored(rows, "bucket-parts")
    split = rows.groupBy("key").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x < y").select("key")
    return stored(rows.join(split, "key", "left_semi"), "divided")


def compare_block(ids: list[int], parts: list[int], chunks: list[int], sets: list[np.ndarray], percent: int,
                  joining: bool = True) -> list[tuple[int, int, bool]]:
    """Pairs of a block in two components that are similar enough by their hashes
    (true), which joins these if ``joining``, or are SLACK shingles short of it.

    Members of the commonest component come last, so that only the others are
    held against all that follow. With two chunks, one is held against the
    other. A pair that earlier pairs have joined isn't compared."""
    common = max(set(parts), key=parts.count)
    order = sorted(range(len(ids)), key=lambda k: parts[k] == common)
    root = {p: p for p in parts}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    sizes = np.array([len(sets[k]) for k in order])
    ends = np.cumsum(sizes)
    begins = ends - sizes
    names, flat = np.unique(np.concatenate([sets[k] for k in order]), return_inverse=True)
    chunk = np.array([chunks[k] for k in order])
    two = chunk.min() != chunk.max()
    marked = np.zeros(len(names), np.int32)
    found = []
    for i, k in enumerate(order[:-1]):
        if parts[k] == common:
            break
        mine = flat[begins[i]:ends[i]]
        marked[mine] = 1
        shared = np.add.reduceat(marked[flat[begins[i + 1]:]], begins[i + 1:] - begins[i + 1])
        marked[mine] = 0
        similar = 100 * shared >= percent * (sizes[i] + sizes[i + 1:] - shared)
        # two shingles of a set may have one hash: the slack leaves such pairs to the full sets
        near = 100 * (shared + SLACK) >= percent * (sizes[i] + sizes[i + 1:] - shared - SLACK)
        if two:
            near &= chunk[i + 1:] != chunk[i]
        for j in np.flatnonzero(near).tolist():
            other = order[i + 1 + j]
            a, b = find(parts[k]), find(parts[other])
            if a != b:
                if similar[j] and joining:
                    root[a] = b
                found.append((ids[k], ids[other], bool(similar[j])))
    return found


def _across(buckets: DataFrame, parts: DataFrame, texts: DataFrame, shingle: int, percent: int, block: int, joining: bool) -> DataFrame:
    """Pairs of one bucket in different components that are or may be similar, by
    blocks: ``a, b, similar``."""
    rows = _divided(buckets, parts)
    chunks = F.ceil(F.col("n") / block)
    rows = (rows.withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), chunks))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
            .select("key", F.least("chunk", "other").alias("x"), F.greatest("chunk", "other").alias("y"), "chunk", "id", "part"))
    members = texts.join(rows.select("id").distinct(), "id", "left_semi")

    def as_set(batches):
        for b in batches:
            sets = []
            buf, offsets = utf8(b.column("text"))
            for k in range(b.num_rows):
                words = Words(buf[offsets[k]:offsets[k + 1]], offsets[k:k + 2] - offsets[k], SPACED)
                sets.append(_sets(words, shingle)[1].tobytes())
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(sets, pa.binary())], ["id", "members"])

    def compare(batches):
        held = None
        for b in batches:
            table = pa.Table.from_batches([b])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < 3 * block:
                continue
            out, held = _compare_groups(held, percent, False, joining)
            yield out
        if held is not None:
            yield _compare_groups(held, percent, True, joining)[0]

    sets = members.select("id", "text").mapInArrow(as_set, "id long, members binary").dropDuplicates(["id"])
    return (rows.join(sets, "id").select("key", "x", "y", "chunk", "id", "part", "members").repartition("key", "x", "y")
            .sortWithinPartitions("key", "x", "y").mapInArrow(compare, "a long, b long, similar boolean"))


def _compare_groups(table: pa.Table, percent: int, ended: bool, joining: bool) -> tuple[pa.RecordBatch, pa.Table]:
    """Links of the whole blocks of a table ordered by block, and the rows of
    the last one, which may go on, unless the input has ended."""
    key, x, y = (table.column(k).to_numpy() for k in ("key", "x", "y"))
    cuts = np.flatnonzero((key[1:] != key[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1
    cuts = [0, *cuts.tolist(), *([table.num_rows] if ended else [])]
    ids, parts, chunks = (table.column(k).to_pylist() for k in ("id", "part", "chunk"))
    members = [np.frombuffer(m, np.uint64) for m in table.column("members").to_pylist()]
    found = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        if min(parts[a:b]) != max(parts[a:b]):
            found += compare_block(ids[a:b], parts[a:b], chunks[a:b], members[a:b], percent, joining)
    columns = list(zip(*found, strict=True)) or [(), (), ()]
    out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.bool_()), strict=True)], ["a", "b", "similar"])
    return out, table.slice(cuts[-1])


def shingles(text: bytes, n: int) -> set:
    """The set of a text, word for word."""
    words = text.lower().split()
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(n)), strict=False))


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough. Rows come ordered by the
    leader, whose set is made once for all its members."""
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))

    def run(batches):
        known, ours = None, set()
        for batch in batches:
            keep = []
            left, right = batch.column("text_a"), batch.column("text_b")
            for k, leader in enumerate(batch.column("a").to_pylist()):
                if leader != known:
                    known, ours = leader, shingles(left[k].as_py(), shingle)
                theirs = shingles(right[k].as_py(), shingle)
                common = len(ours & theirs)
                keep.append(100 * common >= percent * (len(ours) + len(theirs) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(b, "b").join(a, "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _keys(id_col: str, text_col: str) -> dict[str, Column]:
    """What tells documents apart: id and two hashes of the text, none null."""
    key = F.col(id_col).cast("long")
    return {"no_id": key.isNull(), "own_id": F.coalesce(key, F.lit(0).cast("long")),
            "h": F.xxhash64(F.col(text_col)), "h2": F.xxhash64(F.lit(1), F.col(text_col))}


_KEYS = ["no_id", "own_id", "h", "h2"]


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, bands: int, rows: int, block: int) -> DataFrame:
    """The rows of ``near_groups`` with the hashes of their texts. What is linked
    are sets, each by a number and by the text of one of its documents."""
    keys = _keys(id_col, text_col)
    # the binary of the text: any bytes, and no re-encoding on the way
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), keys["h"].alias("h"), keys["h2"].alias("h2"),
                       F.encode(F.col(text_col), "UTF-8").alias("text"))
    none, own = F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0).cast("long"))
    signed = stored(_signed(docs, shingle, bands, rows), "signatures")
    sets = (signed.where("n_shingles > 0").groupBy("set_a", "set_b", "n_shingles")
            .agg(F.min(F.struct(none.alias("no_id"), own.alias("own_id"), "h", "h2")).alias("first"),
                 F.any_value("left").alias("left"), F.any_value("right").alias("right")))
    sets = stored(sets.withColumn("id", F.monotonically_increasing_id()), "sets")
    buckets = _buckets(sets)
    wanted = sets.join(buckets.select("id").distinct(), "id", "left_semi").select("id", "first.*")
    texts = stored(docs.select(none.alias("no_id"), own.alias("own_id"), "h", "h2", "text").where("text IS NOT NULL")
                   .join(wanted, _KEYS).groupBy("id").agg(F.any_value("text").alias("text")), "candidate-texts")

    pairs = stored(_led(buckets, percent), "pairs")
    links = stored(_confirmed(pairs, texts, shingle, percent), "confirmed")
    dropped(pairs)
    parts = stored(components(links), "parts")
    for joining in (True, False):
        found = _across(buckets, parts, texts, shingle, percent, block, joining)
        pairs = stored(found.groupBy("a", "b").agg(F.max("similar").alias("similar")), "pairs")
        more = stored(_confirmed(pairs.select("a", "b"), texts, shingle, percent), "confirmed")
        if not more.isEmpty():
            former, links = links, stored(links.unionByName(more), "confirmed")
            old, parts = parts, stored(components(links), "parts")
            dropped(former, old)
        hidden = not pairs.where("similar").join(more, ["a", "b"], "left_anti").isEmpty()
        dropped(pairs, more)
        if not hidden:
            break
    dropped(buckets, texts, links)
    # the document that stands for each component: the smallest id, those without one last
    linked = stored(parts.join(sets.select("id", "first"), F.col("id") == F.col("node")).select("node", "component", "first"), "linked")
    leads = stored(linked.groupBy("component").agg(F.min("first").alias("lead")), "leads")
    labelled = (sets.join(linked.join(leads, "component").select("node", "lead"), F.col("id") == F.col("node"), "left")
                .select("set_a", "set_b", "n_shingles", F.coalesce("lead", "first").alias("lead")))
    labelled = stored(labelled, "labelled")
    dropped(sets, parts, linked, leads)
    out = signed.select("doc_id", "h", "h2", "n_shingles", "set_a", "set_b").join(labelled, ["set_a", "set_b", "n_shingles"], "left")
    component = F.when(F.col("lead").isNull(), F.col("doc_id")).when(~F.col("lead.no_id"), F.col("lead.own_id"))
    kept = F.col("lead").isNull() | (F.struct(none.alias("no_id"), own.alias("own_id"), "h", "h2") == F.col("lead"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"), "h", "h2")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS,
                block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id that links lead to (itself included).
    Words are what stands between ASCII white space, A-Z in lower case. Texts
    without words, null ones too, have no shingles and are linked with nothing.
    Rows that repeat an id are judged text by text, those without an id too;
    ``component_id`` is null where no linked row has one. ``kept`` is true for one
    text of one id (or of none) in each group, for all rows that repeat both. An
    empty table gives an empty result."""
    return _grouped(docs, id_col, text_col, shingle, percent, bands, rows, block).drop("h", "h2")


def without_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                        percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK) -> DataFrame:
    """``docs`` with one document of each group (the smallest id), columns as they
    were. Rows are told apart by id and text; of those that repeat both, one
    stays where the text has words."""
    own = [F.col("doc_id").isNull().alias("__no_id"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("__own_id"),
           F.col("h").alias("__h"), F.col("h2").alias("__h2")]
    keys = [f"__{k}" for k in _KEYS]
    found = _grouped(docs, id_col, text_col, shingle, percent, bands, rows, block).where("n_shingles > 0")
    gone = stored(found.groupBy(*own).agg(F.min("kept").alias("__kept"), F.count(F.lit(1)).alias("__n"))
                  .where("NOT __kept OR __n > 1"), "near-copies")
    # rows whose ids fall into none of the list's buckets stay where they are
    others, suspects = split_by_ids(docs, _keys(id_col, text_col)["own_id"], gone, "__own_id")
    keyed = suspects.select("*", *[c.alias(f"__{k}") for k, c in _keys(id_col, text_col).items()])
    left = keyed.join(gone.select(*keys), keys, "left_anti")
    repeated = gone.where("__kept").select(*keys)
    if not repeated.isEmpty():
        left = left.unionByName(keyed.join(repeated, keys, "left_semi").dropDuplicates(keys))
    return others.unionByName(left.drop(*keys))
