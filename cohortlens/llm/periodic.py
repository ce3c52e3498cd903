"""Runs: maximal stretches of words that repeat themselves with a smallest period.

A document's suffixes (from each of its words on) are classed by what they begin
with. Going down from the longest common prefixes, two classes of suffixes are
united wherever neighbours in suffix order share that many words (Kruskal's
order, union-find), and every class keeps its positions in order. Positions ``i``
and ``j = i + q`` that become neighbours in a class when it shares ``l`` words have
a longest common prefix of exactly ``l``. If ``q <= l``, the words from ``i`` to
``j + l`` have period ``q``; and it is the smallest, as a smaller period ``p`` would
have put ``i + p`` between them earlier, with a longer prefix. The run can't go on
to the right; it is reported for the pair from which it can't go on to the left
either. So every run is found once, with its start, length and period.

A run of ``shortest`` words or more, twice its period at least, comes from a common
prefix of ``shortest / 2`` words or more: the descent ends there, and documents
without a repeated stretch of so many words have no runs. Suffix order comes from
prefix doubling over many documents at once in numpy; memory is that of a slice of
texts or of one long text."""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import join_hashes, run_hashes

#: Words of the shortest run.
SHORTEST = 12
#: Words of texts that are sorted together (or one text).
SLICE_WORDS = 100_000


def doubled_ranks(first: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """Ranks of every position by its next 1, 2, 4, ... words within its
    document, until no two positions agree. ``first`` are the ranks by one word,
    different in different documents."""
    levels, n = [first], len(first)
    step = 1
    while True:
        rank = levels[-1]
        follows = np.zeros(n, np.int64)
        if step < n:
            same = doc[step:] == doc[:-step]
            follows[:-step][same] = rank[step:][same] + 1
        values, rank = np.unique(rank.astype(np.int64) * (n + 1) + follows, return_inverse=True)
        levels.append(rank)
        if len(values) == n:
            return levels
        step *= 2


def common_prefixes(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Words that the suffixes at ``a`` and ``b`` share (they aren't the same)."""
    n = len(levels[0])
    a, b, shared = a.copy(), b.copy(), np.zeros(len(a), np.int64)
    # beyond a document's end nothing agrees: its last words' ranks hold the end
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        equal = np.zeros(len(a), bool)
        equal[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        shared[equal] += 1 << k
        a[equal] += 1 << k
        b[equal] += 1 << k
    return shared


def runs(first: np.ndarray, doc: np.ndarray, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, in order. ``first``: a number for each
    word, different in different documents; ``doc``: its document's number (ascending)."""
    n = len(first)
    if n < 2:
        return []
    levels = doubled_ranks(np.unique(first, return_inverse=True)[1], doc)
    order = np.argsort(levels[-1], kind="stable")
    prefix = common_prefixes(levels, order[:-1], order[1:])
    least = -(-shortest // 2)
    edges = np.flatnonzero(prefix >= least)
    edges = edges[np.argsort(-prefix[edges], kind="stable")]
    word = levels[0].tolist()
    of = doc.tolist()
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def root(i: int) -> int:
        if i not in parent:
            parent[i], members[i] = i, [i]
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    found = []

    def neighbours(i: int, j: int, shared: int) -> None:
        q = j - i
        if q <= shared and q + shared >= shortest and not (i and of[i - 1] == of[i] and word[i - 1] == word[j - 1]):
            found.append((i, q + shared, q))

    for a, b, shared in zip(order[edges].tolist(), order[edges + 1].tolist(), prefix[edges].tolist(), strict=True):
        a, b = root(a), root(b)
        if len(members[a]) < len(members[b]):
            a, b = b, a
        large, small = members[a], members.pop(b)
        parent[b] = a
        last = len(small) - 1
        places = [bisect_left(large, x) for x in small]
        for k, (x, at) in enumerate(zip(small, places, strict=True)):
            if at and (k == 0 or small[k - 1] < large[at - 1]):
                neighbours(large[at - 1], x, shared)
            if at < len(large) and (k == last or small[k + 1] > large[at]):
                neighbours(x, large[at], shared)
        if len(small) * 8 < len(large):
            for x in small:
                insort(large, x)
        else:
            members[a] = sorted(large + small)
    return sorted(found, key=lambda r: (r[0], r[2]))


def repeating(words: list[bytes], seed: int) -> list[bytes]:
    """The words with a tail that repeats, as the seed says: from word ``a`` on, the
    ``p`` words there again and again."""
    n, g = len(words), seed // 10
    if seed % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * -(-(n - a) // p))[:n - a]


def _candidates(ids: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Documents in which ``width`` words occur at two places (by hash; a few more
    may come in, none is left out)."""
    if len(ids) < width:
        return np.zeros(0, np.int64)
    h = run_hashes(join_hashes(ids.astype(np.uint64), doc.astype(np.uint64)), width)
    same = doc[width - 1:] == doc[:len(h)]
    h, d = h[same], doc[:len(h)][same]
    order = np.argsort(h, kind="stable")
    again = h[order][1:] == h[order][:-1]
    return np.unique(d[order][1:][again])


def document_runs(texts: list[list[bytes]], shortest: int = SHORTEST) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several texts' words."""
    number: dict[bytes, int] = {}
    counts = np.array([len(w) for w in texts], np.int64)
    ids = np.array([number.setdefault(x, len(number)) for w in texts for x in w], np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    chosen = np.isin(doc, _candidates(ids, doc, -(-shortest // 2)))
    if not chosen.any():
        return out
    ids, doc = ids[chosen], doc[chosen]
    begin = {int(d): int(k) for k, d in reversed([*zip(np.flatnonzero(np.diff(doc, prepend=-1)), doc[np.diff(doc, prepend=-1) != 0], strict=True)])}
    for start, length, period in runs(doc * len(number) + ids, doc, shortest):
        d = int(doc[start])
        out[d].append((start - begin[d], length, period))
    return out


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, joined by one space."""
    if not found:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join(words[k] for k in np.flatnonzero(np.cumsum(edge)[:-1] == 0).tolist())


_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST,
              planted: bool = False) -> DataFrame:
    """One row per document: ``doc_id, runs, collapsed``.

    ``runs`` are (start, length, period) in words, by start and then period;
    ``collapsed`` the words left when each run keeps only its first period. Words
    are what lies between ASCII white space. With ``planted``, every tenth
    document by the crc32 of its id first gets a repeating tail (:func:`repeating`).

    A null or empty text has no words and no runs; a null id plants nothing.
    Documents are judged each for itself, those that share an id or a text too; an
    empty table gives an empty result; further columns are ignored."""
    def read(doc, text):
        words = (text or "").encode().split()
        return repeating(words, zlib.crc32(b"%d" % doc)) if planted and doc is not None else words

    def run(batches):
        for b in batches:
            ids = b.column(0).to_pylist()
            texts = [read(*x) for x in zip(ids, b.column(1).to_pylist(), strict=True)]
            first = 0
            while first < len(texts):
                last, held = first, 0
                while last < len(texts) and (last == first or held + len(texts[last]) <= SLICE_WORDS):
                    held += len(texts[last])
                    last += 1
                found = document_runs(texts[first:last], shortest)
                kept = [collapsed(w, r) for w, r in zip(texts[first:last], found, strict=True)]
                rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in x] for x in found]
                yield pa.RecordBatch.from_arrays([pa.array(ids[first:last], pa.int64()), pa.array(rows, _RUN), pa.array(kept, pa.binary())],
                                                 ["doc_id", "runs", "collapsed"])
                first = last

    return (docs.select(F.col(id_col).cast("long"), F.col(text_col))
            .mapInArrow(run, "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed binary"))


def run_digests(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and digests of all runs and of what is left."""
    # greatest length, then smallest start and period, as the smallest (-length, start, period)
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    start, length, period = longest["s"], -longest["l"], longest["p"]
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
                       F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.withColumn("exponent_milli", F.expr("1000L * length div period"))
