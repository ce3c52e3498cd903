"""Byte-level BPE by tree reduction against the tiktoken library."""

import random

import numpy as np
import pytest
import public_tokenizers

from cohortlens.llm import byte_bpe, tokens

from .frames import documents, edge_docs, edge_rows, no_docs, prose


@pytest.fixture(scope="module")
def plain():
    import tiktoken

    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.codec().rank, special_tokens={})
    return e.encode_ordinary


def flat(part):
    return [k for x in part.ids for k in x]


def odd_texts(seed=1):
    r = random.Random(seed)
    out = ["", " ", "  ", " a", "a ", "  a  b ", "a\n b", "it's  o'clock we'll 'l 'll' 'LL", "\x1c b \x85 c", "日本 語 text", "x" * 3000,
           "ab" * 700, " " * 500 + "b", "<|endoftext|>", "🙂" * 50, "a" * 37 + "b" + "a" * 41]
    out += ["".join(r.choice(" ab'1.\n\té  slre!日\xa0") for _ in range(r.randrange(60))) for _ in range(400)]
    out += ["".join(r.choice("etaoinshrdlu") for _ in range(r.randrange(200))) for _ in range(100)]
    return out + ["a꟎1꟎.꟎'s b", "x ՘a \U000323b0's"]


def test_tokens_are_their_own_encoding():
    byte_bpe.codec().check()


def test_merging_by_heap_equals_merging_by_scan(monkeypatch):
    codec, r = byte_bpe.codec(), random.Random(4)
    datas = [bytes(r.choice(b"abcdeth \xc3\xa9") for _ in range(r.randrange(1, 24))) for _ in range(500)]
    scanned = [codec.merged(d) for d in datas]
    monkeypatch.setattr(byte_bpe, "SHORT", 0)
    assert [codec.merged(d) for d in datas] == scanned


@pytest.mark.parametrize("leaf", [1, 3, 16])
def test_matches_by_halves(plain, monkeypatch, leaf):
    monkeypatch.setattr(byte_bpe, "LEAF", leaf)
    codec = byte_bpe.Codec()
    for x in odd_texts():
        assert flat(codec.part(x)) == plain(x), repr(x[:60])


def test_any_cut_of_a_text_joins_to_the_same(plain):
    codec, r = byte_bpe.codec(), random.Random(2)
    for x in odd_texts(3) + [prose(1, 200)]:
        cuts = sorted(r.randrange(len(x) + 1) for _ in range(r.randrange(9)))
        parts = [codec.part(x[a:b]) for a, b in zip([0, *cuts], [*cuts, len(x)], strict=True)]
        whole = codec.tree(parts)
        assert "".join(whole.pieces) == x and whole.pieces == byte_bpe.split(x) and flat(whole) == plain(x), repr(x[:60])


def test_windows_grow_where_a_cut_shifts_all_that_follows():
    codec = byte_bpe.codec()
    for n in (2 ** 12 + 1, 2 ** 12 - 1):
        data = b"a" * n
        assert codec.join(codec.encode(b"a" * 3), codec.encode(data[3:])) == codec.merged(data)


def test_splits_agree_on_every_character(plain):
    codec = byte_bpe.codec()
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]):
        text = f"{c}'s{c}"
        assert flat(codec.part(text)) == plain(text), hex(ord(c))


def check(rows, want, plain):
    got = sorted((r.doc_id is not None, r.doc_id or 0, bytes(r.ids), bytes(r.decoded)) for r in rows)
    assert got == sorted((i is not None, i or 0, np.array(plain(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in want)


@pytest.mark.parametrize("block", [7, 1000, byte_bpe.BLOCK])
def test_documents(spark, plain, block):
    texts = odd_texts() + [prose(9, 500), None]
    texts = texts[::12] if block == 7 else texts
    rows = byte_bpe.decode(byte_bpe.encode(documents(spark, texts), block=block, fan_in=3)).collect()
    check(rows, list(enumerate(texts)), plain)


def test_edge_documents(spark, plain):
    rows = byte_bpe.decode(byte_bpe.encode(edge_docs(spark), block=50_000)).collect()
    check(rows, [(i, t) for i, t, *_ in edge_rows()], plain)
    assert byte_bpe.decode(byte_bpe.encode(no_docs(spark))).collect() == []


def test_both_libraries_split_alike(plain):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.VOCABULARY)
    for c in map(chr, tokens.newer_characters()[::7]):
        text = f"a{c}1{c}.{c}'s"
        assert t.encode(text, add_special_tokens=False).ids == plain(text), hex(ord(c))
