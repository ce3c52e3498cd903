"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A test string is a window of consecutive words of a benchmark item. The search
runs over the words of a text as its letters:

- the *shift table* tells for the block of two words at the cursor how far no
  test string can end, and the cursor jumps by so much;
- where the shift is zero, the hash of the last and of the first block of the
  window under the cursor selects a *bucket* of test strings;
- those are compared with the text, first word by word through their hashes,
  then byte by byte.

Many cursors (one for each stretch of words) move at once, as numpy arrays.
Test strings of one length are searched together; shorter items are test
strings of their own length.

The benchmark is the stated query set: it is cut into blocks of items of a
bounded number of words, and each block's tables are broadcast and searched
for in all documents. One block needs no shuffle at all."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, stored, utf8
from .words import ALNUM, Words, join_hashes, run_hashes

#: Words of a window, and the most windows that one broadcast block holds.
WINDOW, BLOCK_WINDOWS = 10, 1 << 17
#: Words that one cursor searches.
STRETCH = 256


class TestStrings:
    """Tables for the test strings of one length."""

    def __init__(self, length: int, hashes: list[np.ndarray], texts: list[bytes], items: list[list[str]]):
        self.length, self.texts, self.items = length, texts, items
        self.block = min(2, length)
        a = np.array(hashes, np.uint64)
        blocks = np.stack([self._blocks(a[:, k:k + self.block].T) for k in range(length - self.block + 1)], 1)
        self.bits = np.uint64(64 - max(16, int(4 * blocks.size).bit_length()))
        self.shift = np.full(1 << (64 - int(self.bits)), length - self.block + 1, np.uint16)
        for k in range(blocks.shape[1]):  # nearer the end later: the smallest shift stays
            self.shift[blocks[:, k] >> self.bits] = blocks.shape[1] - 1 - k
        keys = join_hashes(blocks[:, -1], blocks[:, 0])
        self.order = np.argsort(keys, kind="stable")
        self.keys, self.words = keys[self.order], a[self.order]

    def _blocks(self, words) -> np.ndarray:
        return words[0] if self.block == 1 else join_hashes(words[0], words[1])

    def _block_at(self, hashes: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._blocks([hashes[end - self.block + 1 + k] for k in range(self.block)])

    def candidates(self, words: Words) -> np.ndarray:
        """Last words of the windows at which the shift table stops."""
        n = self.length
        first, last = words.first[:-1] + n - 1, words.first[1:]
        some = last > first
        first, last = first[some], last[some]
        if not len(first):
            return first
        counts = -(-(last - first) // STRETCH)
        begin = np.repeat(first, counts) + STRETCH * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
        stop = np.minimum(begin + STRETCH, np.repeat(last, counts))
        found, at = [], begin
        while len(at):
            jump = self.shift[self._block_at(words.hash, at) >> self.bits].astype(np.int64)
            found.append(at[jump == 0])
            at = at + np.maximum(jump, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        return np.concatenate(found)

    def matches(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(last word, test string) of every occurrence."""
        end = self.candidates(words)
        begin = end - self.length + 1
        key = join_hashes(self._block_at(words.hash, end), self._block_at(words.hash, begin + self.block - 1))
        low, high = np.searchsorted(self.keys, key, "left"), np.searchsorted(self.keys, key, "right")
        counts = high - low
        where = np.repeat(np.arange(len(end)), counts)
        entry = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        for k in range(self.length):
            same = words.hash[begin[where] + k] == self.words[entry, k]
            where, entry = where[same], entry[same]
        test = self.order[entry]
        sure = [b" ".join([words.text(w) for w in range(e - self.length + 1, e + 1)]) == self.texts[t]
                for e, t in zip(end[where].tolist(), test.tolist(), strict=True)]
        return end[where][sure], test[sure]


def compile_block(rows: list[tuple[str, bytes]], window: int = WINDOW) -> list[TestStrings]:
    """Tables of the items (name, text), one for each length of test string."""
    by_text: dict[int, dict[bytes, tuple[np.ndarray, set[str]]]] = defaultdict(dict)
    for name, text in rows:
        w = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), ALNUM)
        n = min(window, len(w.start))
        if not n:
            continue
        single = [w.text(k) for k in range(len(w.start))]
        for k in range(len(single) - n + 1):
            by_text[n].setdefault(b" ".join(single[k:k + n]), (w.hash[k:k + n], set()))[1].add(name)
    return [TestStrings(n, [h for h, _ in tests.values()], list(tests), [sorted(s) for _, s in tests.values()])
            for n, tests in sorted(by_text.items())]


def search(texts: pa.Array, tables: list[TestStrings]) -> Iterator[tuple[int, list[tuple[int, int]], set[str]]]:
    """Per text: number of words, hit runs of words [first, end), item names."""
    buf, offsets = utf8(texts)
    for a, b in slices(offsets):
        words = Words(buf[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], ALNUM)
        change = np.zeros(len(words.start) + 1, np.int32)
        names: dict[int, set[str]] = defaultdict(set)
        for t in tables:
            ends, tests = t.matches(words)
            np.add.at(change, ends - t.length + 1, 1)
            np.add.at(change, ends + 1, -1)
            for row, test in set(zip(words.row[ends].tolist(), tests.tolist(), strict=True)):
                names[row].update(t.items[test])
        hit = np.cumsum(change)[:-1] > 0
        for row in range(b - a):
            first, end = words.first[row], words.first[row + 1]
            runs = []
            if row in names:
                edge = np.diff(np.concatenate([[0], hit[first:end].view(np.int8), [0]]))
                runs = list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))
            yield int(end - first), runs, names.get(row, set())


_SPANS = "array<struct<first:int,end:int>>"
_RESULT = f"doc_id long, _text_hash long, n_words long, hit_words {_SPANS}, items array<string>"


def _search_all(docs: DataFrame, tables: Broadcast) -> DataFrame:
    span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for b in batches:
            counts, runs, items = [], [], []
            for n, r, s in search(b.column("text"), tables.value):
                counts.append(n)
                runs.append([{"first": x, "end": y} for x, y in r])
                items.append(sorted(s))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("_text_hash"), pa.array(counts, pa.int64()), pa.array(runs, span),
                 pa.array(items, pa.list_(pa.string()))],
                ["doc_id", "_text_hash", "n_words", "hit_words", "items"])

    return docs.mapInArrow(run, _RESULT)


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_windows: int) -> Iterator[list[tuple[str, bytes]]]:
    """The items in blocks of at most about ``block_windows`` bytes-bounded
    windows, one block at a time."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("name"),
                             F.col(text_col).alias("text")).where("text IS NOT NULL")
    # a text of n bytes has at most n / 2 + 1 words, and so fewer windows
    total = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    n = max(1, int(-(-total // block_windows)))
    for k in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == k)
        yield [(r.name_, r.text.encode("utf-8")) for r in part.withColumnRenamed("name", "name_").toLocalIterator()]


def _leaks(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str,
           window: int, block_windows: int) -> DataFrame:
    """The rows of ``find_leaks`` with the hash of their text."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(F.col(text_col)).alias("_text_hash"))
    send = docs.sparkSession.sparkContext.broadcast
    once, hits, tables, keys = None, None, None, ["doc_id", "_text_hash"]
    for rows in benchmark_blocks(benchmark, item_col, item_text_col, block_windows):
        if tables is not None:  # what the block before found is stored, and its tables go
            found = stored(_search_all(docs, tables) if once is None else _search_all(docs, tables).where("size(items) > 0"), "leaks")
            tables.destroy()
            once, hits = (found, found.where("size(items) > 0")) if once is None else (once, hits.unionByName(found))
        tables = send(compile_block(rows, window))
    if once is None:  # one block
        return _search_all(docs, tables)
    # several blocks: merge what each found in a document; rows that repeat id and text found the same
    hits = hits.unionByName(stored(_search_all(docs, tables).where("size(items) > 0"), "leaks"))
    tables.destroy()
    merged = hits.groupBy(*[F.coalesce(k, F.lit(0).cast("long")).alias(f"_{k}") for k in keys], F.col("doc_id").isNull().alias("_no_id")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("hit_words")))).alias("_runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("_items"))
    return (once.join(merged, (F.coalesce("doc_id", F.lit(0).cast("long")) == F.col("_doc_id"))
                      & (F.coalesce("_text_hash", F.lit(0).cast("long")) == F.col("__text_hash"))
                      & (F.col("doc_id").isNull() == F.col("_no_id")), "left")
            .select("doc_id", "_text_hash", "n_words", F.coalesce(_united(F.col("_runs")), "hit_words").alias("hit_words"),
                    F.coalesce("_items", "items").alias("items")))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
               block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: ``doc_id, n_words, hit_words, items``.

    ``hit_words`` are the runs [first, end) of words inside occurrences of test
    strings, ``items`` the names of the items these come from, sorted. A null
    text has no words; an item without an id is called ``null``; items without
    words match nothing; repeated documents and items count as they are. Empty
    tables give an empty result, or one without hits."""
    return _leaks(docs, benchmark, id_col, text_col, item_col, item_text_col, window, block_windows).drop("_text_hash")


def _united(runs):
    """Sorted runs, those that overlap or touch made one."""
    joined = F.aggregate(runs, F.expr(f"cast(array() AS {_SPANS})"), lambda out, r: F.when(
        (F.size(out) > 0) & (F.element_at(out, -1)["end"] >= r["first"]),
        F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(
            F.element_at(out, -1)["first"].alias("first"),
            F.greatest(F.element_at(out, -1)["end"], r["end"]).alias("end")))))
        .otherwise(F.concat(out, F.array(r))))
    return joined


def without_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` without the documents that hold a test string, columns as they
    were. Rows that share an id, or have none, are judged text by text."""
    leaks = _leaks(docs, benchmark, id_col, text_col, item_col, item_text_col, window, block_windows).where("size(items) > 0")
    bad = stored(leaks.select(F.col("doc_id").alias("__leak"), F.col("_text_hash").alias("__leak_text")).distinct(), "leaking")
    return docs.join(bad, F.col(id_col).cast("long").eqNullSafe(F.col("__leak"))
                     & (F.xxhash64(F.col(text_col)) == F.col("__leak_text")), "left_anti")
