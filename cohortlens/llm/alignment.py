"""Alignment of two tokenizers' tokens over the same bytes.

A is a byte-level vocabulary, B one of pieces with a space in front of the text.
Both tokenise space + text; a token is a range of its bytes. In every Arrow
batch, ``pandas.merge_asof``, keyed by document, gives the start of each token the
other side's token that covers it. The union of both directions holds all pairs
that overlap: of two overlapping tokens, the one that starts later starts inside
the other. Pairs that end together are links; where both sides end, a group ends.

How often an id pair is linked is counted over all documents. Tokens that end
together have one's bytes at the end of the other's, so there are no more distinct
pairs than such pairs of entries (:func:`pair_bound`, some hundred thousand): the
vocabularies, not the corpus, bound the table that goes to every task."""

from __future__ import annotations

import hashlib
import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import stored

A_VOCABULARY, B_MODEL = tokens.VOCABULARY, public_tokenizers.path("piece_bpe_32k.model")
#: Bytes of texts that are aligned at once (or one text).
SLICE_BYTES = 1 << 18


class Side:
    """A vocabulary's entries by id: their bytes, lengths and decimal ids."""

    def __init__(self, entries: list[bytes]):
        self.entries = entries
        self.length = np.array([len(x) for x in entries], np.int64)

    def bytes(self, ids: list[int]) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))


class Tokenizers:
    def __init__(self, a_vocabulary: str, b_model: str):
        import sentencepiece

        self.encoder = tokens.encoder(a_vocabulary, plain_added=True)
        vocabulary = self.encoder.tokenizer.get_vocab(with_added_tokens=True)
        added = set(self.encoder.added)
        a = [b""] * (max(vocabulary.values()) + 1)
        for entry, k in (tokens.byte_entries({x: k for x, k in vocabulary.items() if x not in added}) or {}).items():
            a[k] = entry
        self.model = sentencepiece.SentencePieceProcessor(model_file=b_model)
        pieces = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        b = [bytes([int(p[3:5], 16)]) if self.model.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.a, self.b = Side(a), Side(b)
        self.decimal = [b"%d" % k for k in range(max(len(a), len(b)))]
        # an id before each mark: within a side, between sides, between groups, at the end
        self.written = [d + mark for mark in (b",", b"|", b";", b"") for d in self.decimal]

    def ids(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Both sides' ids of each text; none where the tokens' bytes aren't those of space + text."""
        a, b = [[] for _ in texts], [[] for _ in texts]
        full = [k for k, t in enumerate(texts) if t]
        for k, y in zip(full, self.model.encode([texts[k] for k in full], num_threads=1), strict=True):
            whole = " " + texts[k]
            data, x = whole.encode(), self.encoder.ids(whole)
            if self.a.bytes(x) == data and self.b.bytes(y) == data:
                a[k], b[k] = x, y
        return a, b


@lru_cache(maxsize=2)
def tokenizers(a_vocabulary: str = A_VOCABULARY, b_model: str = B_MODEL) -> Tokenizers:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizers(a_vocabulary, b_model)


def pair_bound(a: list[bytes], b: list[bytes]) -> int:
    """Pairs of entries of which one ends with the other: as many as can be linked."""
    def ending(long: list[bytes], short: list[bytes], shortest_first: int) -> int:
        count: dict[bytes, int] = {}
        for x in short:
            count[x] = count.get(x, 0) + 1
        return sum(count.get(x[k:], 0) for x in long for k in range(shortest_first, len(x)))

    return ending(a, b, 0) + ending(b, a, 1)


def tokens_of(ids: list[list[int]], lengths: np.ndarray) -> pd.DataFrame:
    """One row per token: ``doc, id, start, end``; bytes are counted on over the
    documents, of which each has a place of its own."""
    flat = np.fromiter(chain.from_iterable(ids), np.int64)
    doc = np.repeat(np.arange(len(ids)), [len(x) for x in ids])
    end = np.cumsum(lengths[flat])
    return pd.DataFrame({"doc": doc, "id": flat, "start": end - lengths[flat], "end": end})


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """Pairs of tokens (their rows ``a`` and ``b``) that share a byte, from both
    directions; both sides cover the same bytes of each document."""
    a, b = a.assign(a=np.arange(len(a))), b.assign(b=np.arange(len(b)))
    # a token without bytes covers nothing and is covered by nothing
    a, b = a[a["start"] < a["end"]], b[b["start"] < b["end"]]
    by_a = pd.merge_asof(a[["doc", "start", "a"]], b[["doc", "start", "b"]], on="start", by="doc")
    by_b = pd.merge_asof(b[["doc", "start", "b"]], a[["doc", "start", "a"]], on="start", by="doc")
    # those that start together are in both directions
    starts = set_membership(by_b["start"].to_numpy(), a["start"].to_numpy())
    return pd.concat([by_a[["a", "b"]], by_b.loc[~starts, ["a", "b"]]], ignore_index=True)


def set_membership(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values are among the ascending ones."""
    if not len(ascending):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)
    return ascending[at] == values


def align(a_ids: list[list[int]], b_ids: list[list[int]], kit: Tokenizers) -> tuple[np.ndarray, list[np.ndarray], list[bytes]]:
    """Of each document: number of groups, links (A id << 32 | B id, in order) and the groups as text."""
    n = len(a_ids)
    a, b = tokens_of(a_ids, kit.a.length), tokens_of(b_ids, kit.b.length)
    if not len(a):
        return np.zeros(n, np.int64), [np.zeros(0, np.int64)] * n, [b""] * n
    a_end, b_end = a["end"].to_numpy(), b["end"].to_numpy()
    pairs = overlaps(a, b)
    x, y = pairs["a"].to_numpy(), pairs["b"].to_numpy()
    together = a_end[x] == b_end[y]
    x, y = x[together], y[together]
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    link = a["id"].to_numpy()[x] << 32 | b["id"].to_numpy()[y]
    link_doc = a["doc"].to_numpy()[x]
    ends = a_end[x]  # ascending: where groups end
    ends = ends[np.diff(ends, prepend=-1) != 0]
    counts = np.bincount(a["doc"].to_numpy()[np.searchsorted(a_end, ends)], minlength=n)
    # tokens by group, A before B, each with the mark that follows it
    group = np.concatenate([np.searchsorted(ends, a_end) * 2, np.searchsorted(ends, b_end) * 2 + 1])
    doc = np.concatenate([a["doc"].to_numpy(), b["doc"].to_numpy()])
    order = np.argsort(group, kind="stable")
    group, doc, ids = group[order], doc[order], np.concatenate([a["id"].to_numpy(), b["id"].to_numpy()])[order]
    mark = np.full(len(group), 3)
    mark[:-1] = np.where(group[1:] == group[:-1], 0, np.where(group[1:] >> 1 == group[:-1] >> 1, 1, np.where(doc[1:] == doc[:-1], 2, 3)))
    codes = (mark * len(kit.decimal) + ids).tolist()
    cuts = np.searchsorted(doc, np.arange(n + 1)).tolist()
    texts = [b"".join(map(kit.written.__getitem__, codes[p:q])) for p, q in zip(cuts, cuts[1:], strict=False)]
    return counts, np.split(link, np.searchsorted(link_doc, np.arange(1, n))), texts


_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups string, links array<long>"


def aligned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", a_vocabulary: str = A_VOCABULARY,
            b_model: str = B_MODEL, digest: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_a, n_b, n_groups, groups, links``.

    ``groups`` is ``a1,a2|b1;a3|b2,b3`` (ids; with ``digest`` its SHA-256, '' without
    tokens), ``links`` the linked pairs as ``A id << 32 | B id`` in order. A null or
    empty text, or one that a side doesn't give back byte by byte, has no tokens.
    Rows that repeat an id or a text are aligned each for itself; an empty table
    gives an empty result; further columns are ignored."""
    def run(batches):
        kit = tokenizers(a_vocabulary, b_model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            first = 0
            while first < len(texts):
                last, held = first, 0
                while last < len(texts) and (last == first or held + len(texts[last] or "") <= SLICE_BYTES):
                    held += len(texts[last] or "")
                    last += 1
                a, b = kit.ids(texts[first:last])
                counts, links, groups = align(a, b, kit)
                if digest:
                    groups = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
                offsets = np.cumsum([0, *(len(x) for x in links)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array([len(x) for x in a], pa.int64()), pa.array([len(x) for x in b], pa.int64()),
                     pa.array(counts, pa.int64()), pa.array([g if digest else g.decode() for g in groups], pa.string()),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(links), pa.int64()))],
                    ["doc_id", "n_a", "n_b", "n_groups", "groups", "links"])
                first = last

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, _ALIGNED)


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, n``: how many links of all documents hold each pair. Batches count
    what they hold, Spark adds up."""
    def run(batches):
        for b in batches:
            pair, n = np.unique(b.column("links").flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(pair, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])

    return rows.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def with_counts(rows: DataFrame, a_vocabulary: str = A_VOCABULARY, b_model: str = B_MODEL) -> DataFrame:
    """The stored rows of :func:`aligned` with ``n_best`` (links whose pair is, of
    all of its B id, linked most often, ties included) and ``count_sum``."""
    counted = pair_counts(rows)
    kit = tokenizers(a_vocabulary, b_model)
    bound = pair_bound(kit.a.entries, kit.b.entries)
    table = counted.toArrow()
    if len(table) > bound:
        raise AssertionError("tokens were linked that don't end alike")
    pair, n = table.column("pair").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(pair)
    pair, n = pair[order], n[order]
    most = np.zeros(len(kit.b.entries), np.int64)
    np.maximum.at(most, pair & 0xFFFFFFFF, n)
    shared = rows.sparkSession.sparkContext.broadcast((pair, n, n == most[pair & 0xFFFFFFFF]))

    def run(batches):
        pair, n, best = shared.value
        for b in batches:
            links = b.column("links")
            offsets = links.offsets.to_numpy()
            at = np.searchsorted(pair, links.flatten().to_numpy())
            bests, sums = (np.concatenate([[0], np.cumsum(x[at])]) for x in (best.astype(np.int64), n))
            offsets = offsets - offsets[0]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.diff(bests[offsets])), pa.array(np.diff(sums[offsets]))],
                                             [*b.schema.names, "n_best", "count_sum"])

    return rows.mapInArrow(run, f"{_ALIGNED}, n_best long, count_sum long")


def link_table(docs: DataFrame, **options) -> DataFrame:
    """Alignment of ``docs`` with the corpus-wide counts (see :func:`aligned`,
    :func:`with_counts`), computed once and stored."""
    rows = stored(aligned(docs, **options), "alignment")
    return with_counts(rows, **{k: v for k, v in options.items() if k in ("a_vocabulary", "b_model")})
