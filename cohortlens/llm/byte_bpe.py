"""Byte-level BPE by tree reduction: encoded parts form a monoid.

An encoded part can be joined to the next one without encoding either again, so
that a text is encoded in halves, on one core or on many, and joined up the tree.

*Tokens.* The halves of a pattern's match are encoded recursively. Their tokens
joined are right if the two at the seam stay as they are when only they are
merged. Else a window of tokens on both sides is merged anew, and grows on each
side until its outermost token and the neighbour outside stay as they are. Why
that suffices: let every token be its own encoding (checked when the ranks are
loaded) and every pair of neighbours be the encoding of their bytes. Merging all
bytes always takes the lowest rank, leftmost first. Look at its first merge across
the border of two tokens. Until then each token's bytes were merged by themselves,
so that merging only this pair would have come to the same merge; but it keeps
both tokens. Hence no merge ever crosses a border.

*Matches.* The pattern has no look-behind: how it goes on from a place depends on
the text from there on only. The last matches of the left part, whose look-ahead
may reach its end, and a growing number of the right part's first matches are
matched again, until a match ends where one of the right part's begins.

Decoding maps ids to their bytes and concatenates them up the tree.

Texts up to ``BLOCK`` characters are encoded where they lie. Longer ones are cut
into blocks, which Spark deals out, encodes and joins, ``FAN_IN`` neighbours a
round, so that one very long text is the work of many tasks."""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from . import tokens
from .common import stored

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Characters of a block, blocks that a round joins, and ids of a leaf when decoding.
BLOCK, FAN_IN, DECODE_LEAF = 1 << 16, 8, 1 << 12
#: Bytes of a match that are merged without halving it, bytes up to which merging
#: looks at all pairs each time, and a rank that no pair has.
LEAF, SHORT, NEVER = 16, 24, 1 << 62
#: Matches and pairs of tokens that a worker remembers in each of two halves, and
#: the longest match it remembers.
REMEMBERED, LONGEST = 200_000, 32
#: Characters from a match's begin that the pattern's alternatives may look at
#: before they run on to a match's end ("'ll").
LOOK_AHEAD = 3
_PATTERN = regex.compile(public_tokenizers.PATTERN)


class _Remembered(dict):
    """A bounded memory of a function: what is used again comes back from the older
    half. Keys longer than LONGEST aren't remembered."""

    def __init__(self, make: Callable, most: int = REMEMBERED):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        if len(key) > LONGEST:
            return self.make(key)
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


@dataclass
class Part:
    """An encoded stretch of text: the pattern's matches and the ids of each."""

    pieces: list[str]
    ids: list[tuple[int, ...]]


class Codec:
    def __init__(self, ranks: str = RANKS):
        with open(ranks, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = [b""] * (max(self.rank.values()) + 1)
        for token, k in self.rank.items():
            self.bytes_of[k] = token
        self.stays = _Remembered(lambda pair: self.merged(self.bytes_of[pair[0]] + self.bytes_of[pair[1]]) == pair)
        self.known = _Remembered(lambda piece: self.encode(piece.encode()))

    def check(self) -> None:
        """Every token is its own encoding, which the joins rely on."""
        for token, k in self.rank.items():
            if self.merged(token) != (k,):
                raise ValueError(f"token {k} isn't the encoding of its bytes")

    def merged(self, data: bytes) -> tuple[int, ...]:
        """Ids of ``data`` by merging pairs, the lowest rank first, leftmost of equals."""
        n, rank = len(data), self.rank
        if n <= SHORT:
            parts = [data[i:i + 1] for i in range(n)]
            ranks = [rank.get(data[i:i + 2], NEVER) for i in range(n - 1)]
            while ranks and (least := min(ranks)) < NEVER:
                i = ranks.index(least)
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
                del ranks[i]
                if i:
                    ranks[i - 1] = rank.get(parts[i - 1] + parts[i], NEVER)
                if i < len(ranks):
                    ranks[i] = rank.get(parts[i] + parts[i + 1], NEVER)
            return tuple([rank[x] for x in parts])
        stop = [*range(1, n + 1), n]  # the token at i ends at stop[i]; 0 once it is part of another
        before = list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank.get(data[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, end = heappop(heap)
            middle = stop[i]
            if not middle or middle >= n or stop[middle] != end:
                continue
            stop[i], stop[middle] = end, 0
            if end < n:
                before[end] = i
                if (r := rank.get(data[i:stop[end]])) is not None:
                    heappush(heap, (r, i, stop[end]))
            if (b := before[i]) >= 0 and (r := rank.get(data[b:end])) is not None:
                heappush(heap, (r, b, end))
        out, i = [], 0
        while i < n:
            out.append(rank[data[i:stop[i]]])
            i = stop[i]
        return tuple(out)

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """Ids of the bytes of ``left`` and ``right`` together."""
        if not left or not right or self.stays[left[-1], right[0]]:
            return left + right
        a = b = 1
        while True:
            window = self.merged(b"".join(map(self.bytes_of.__getitem__, left[-a:] + right[:b])))
            left_holds = a >= len(left) or self.stays[left[-a - 1], window[0]]
            right_holds = b >= len(right) or self.stays[window[-1], right[b]]
            if left_holds and right_holds:
                return left[:max(0, len(left) - a)] + window + right[b:]
            a, b = a if left_holds else 2 * a, b if right_holds else 2 * b

    def encode(self, data: bytes) -> tuple[int, ...]:
        """Ids of one match: its halves, joined."""
        k = self.rank.get(data)
        if k is not None:
            return (k,)
        if len(data) <= LEAF:
            return self.merged(data)
        half = len(data) // 2
        return self.join(self.encode(data[:half]), self.encode(data[half:]))

    def part(self, text: str) -> Part:
        """A stretch of text by itself."""
        pieces = split(text)
        return Part(pieces, list(map(self.known.__getitem__, pieces)))

    def joined(self, left: Part, right: Part) -> Part:
        """The stretch that ``left`` and ``right`` make."""
        if not left.pieces or not right.pieces:
            return left if left.pieces else right
        keep, tail = len(left.pieces), 0
        while keep and tail < LOOK_AHEAD:
            keep -= 1
            tail += len(left.pieces[keep])
        taken, most = 2, len(right.pieces)
        while True:
            window = "".join(left.pieces[keep:] + right.pieces[:taken])
            settled = len(window) + (taken >= most) - 1  # what ends here has seen what stops it
            begins = {tail: 0}
            at = tail
            for k, x in enumerate(right.pieces[:taken], 1):
                at += len(x)
                begins[at] = k
            found, at = [], 0
            for x in split(window):
                if at >= tail and at in begins or at + len(x) > settled or (at + LOOK_AHEAD > len(window) and taken < most):
                    break
                found.append(x)
                at += len(x)
            if at in begins:
                break
            taken *= 2
        ids = []
        at = 0
        for x in found:
            if at + len(left.pieces[-1]) == tail and x == left.pieces[-1] + right.pieces[0]:
                ids.append(self.join(left.ids[-1], right.ids[0]))  # one match through the seam
            else:
                ids.append(self.known[x])
            at += len(x)
        rest = begins[at]
        return Part(left.pieces[:keep] + found + right.pieces[rest:], left.ids[:keep] + ids + right.ids[rest:])

    def tree(self, parts: list[Part]) -> Part:
        """Neighbours joined, level by level."""
        while len(parts) > 1:
            pairs = [self.joined(*parts[k:k + 2]) for k in range(0, len(parts) - 1, 2)]
            parts = pairs + parts[2 * len(pairs):]
        return parts[0] if parts else Part([], [])

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids: those of its halves, one after the other."""
        if len(ids) <= DECODE_LEAF:
            return b"".join(map(self.bytes_of.__getitem__, ids.tolist()))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


#: A character that is neither a letter nor a number nor white space stands in for
#: those that only newer Unicode tables than the tiktoken library's know.
_STAND_IN = {k: "\ue000" for k in tokens.newer_characters()}
_NEWER = re.compile("[%s]" % "".join("-".join(chr(int(c, 16)) for c in run.split("-")) for run in tokens.NEWER.split()))


#: Below this character, Python's own expressions match the pattern, twice as fast.
_FEW = 0x250


def _class(name: str) -> str:
    return "".join(f"\\u{k:04x}" for k in range(_FEW) if regex.match(name, chr(k)))


def _plain_pattern() -> re.Pattern:
    """The pattern with its classes spelt out, as far as they are below ``_FEW``."""
    letter, number, space = map(_class, (r"\p{L}", r"\p{N}", r"\s"))
    spelt = public_tokenizers.PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{space}{letter}{number}]")
    return re.compile(spelt.replace(r"\p{L}", f"[{letter}]").replace(r"\p{N}", f"[{number}]").replace(r"\s", f"[{space}]").replace(r"\S", f"[^{space}]"))


_PLAIN, _BEYOND = _plain_pattern(), re.compile(f"[^\\x00-\\u{_FEW - 1:04x}]")


def split(text: str) -> list[str]:
    """The pattern's matches, as the tiktoken library's Unicode tables have them."""
    if not _BEYOND.search(text):
        return _PLAIN.findall(text)
    if not _NEWER.search(text):
        return _PATTERN.findall(text)
    return [text[a:b] for a, b in (m.span() for m in _PATTERN.finditer(text.translate(_STAND_IN)))]


@lru_cache(maxsize=4)
def codec(ranks: str = RANKS) -> Codec:
    """The worker's codec, made once."""
    return Codec(ranks)


def serialised(ids: list[tuple[int, ...]]) -> bytes:
    return np.fromiter(chain.from_iterable(ids), "<u4").tobytes()


def _text_blocks(text: str, size: int) -> Iterator[str]:
    for k in range(0, len(text), size):
        yield text[k:k + size]


_PART = "row string, doc_id long, block int, text string, lengths binary, counts binary, ids binary"


def _part_columns(parts: list[Part]) -> list[pa.Array]:
    return [pa.array(["".join(p.pieces) for p in parts], pa.string()),
            pa.array([np.fromiter(map(len, p.pieces), "<i4").tobytes() for p in parts], pa.binary()),
            pa.array([np.fromiter(map(len, p.ids), "<i4").tobytes() for p in parts], pa.binary()),
            pa.array([serialised(p.ids) for p in parts], pa.binary())]


def _read_part(text: str, lengths: bytes, counts: bytes, ids: bytes) -> Part:
    ends = np.cumsum(np.frombuffer(lengths, "<i4"), dtype=np.int64).tolist()
    stops = np.cumsum(np.frombuffer(counts, "<i4"), dtype=np.int64).tolist()
    all_ids = np.frombuffer(ids, "<u4").tolist()
    return Part([text[a:b] for a, b in zip([0, *ends], ends, strict=False)],
                [tuple(all_ids[a:b]) for a, b in zip([0, *stops], stops, strict=False)])


def _by_blocks(docs: DataFrame, ranks: str, size: int, fan_in: int) -> DataFrame | None:
    """``doc_id, ids`` of long texts, whose blocks are dealt out; None without any."""
    def cut(batches):
        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                row = uuid.uuid4().hex  # rows may share id and text; what is stored keeps its name
                for k, block in enumerate(_text_blocks(text, size)):
                    yield pa.RecordBatch.from_arrays([pa.array([row]), pa.array([doc], pa.int64()), pa.array([k], pa.int32()), pa.array([block])],
                                                     ["row", "doc_id", "block", "text"])

    blocks = stored(docs.mapInArrow(cut, "row string, doc_id long, block int, text string"), "bpe-blocks")
    last = blocks.agg(F.max("block")).first()[0]
    if last is None:
        return None

    def leaves(batches):
        for b in batches:
            parts = [codec(ranks).part(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in range(3)), *_part_columns(parts)],
                                             ["row", "doc_id", "block", "text", "lengths", "counts", "ids"])

    def joined(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        whole = codec(ranks).tree([_read_part(*x) for x in zip(*(table.column(c).to_pylist() for c in ("text", "lengths", "counts", "ids")), strict=True)])
        return pa.Table.from_arrays([*(table.column(c).slice(0, 1) for c in ("row", "doc_id", "into")), *_part_columns([whole])],
                                    ["row", "doc_id", "block", "text", "lengths", "counts", "ids"])

    parts = blocks.repartition("row", "block").mapInArrow(leaves, _PART)
    n = last + 1
    while n > 1:
        n = -(-n // fan_in)
        grouped = parts.withColumn("into", F.expr(f"cast(block div {fan_in} as int)")).groupBy("row", "into")
        parts = grouped.applyInArrow(joined, _PART)
    return parts.select("doc_id", "ids")


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS,
           block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """One row per document: ``doc_id, ids`` (little-endian unsigned 32-bit).

    A null or empty text has no ids. Rows that repeat an id or a text are encoded
    each for itself; an empty table gives an empty result; further columns are
    ignored. Special tokens' strings are plain text."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def whole(batches):
        for b in batches:
            own = codec(ranks)
            ids = [serialised(own.part(t).ids) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    short = docs.where(F.length("text") <= block).mapInArrow(whole, "doc_id long, ids binary")
    long = _by_blocks(docs.where(F.length("text") > block), ranks, block, fan_in)
    return short if long is None else short.unionByName(long)


def decode(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of its ``ids`` (null: none)."""
    def run(batches):
        for b in batches:
            ids = [np.frombuffer(x or b"", "<u4") for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([codec(ranks).decode(x) for x in ids], pa.binary())],
                                             [*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField("decoded", BinaryType())]))
