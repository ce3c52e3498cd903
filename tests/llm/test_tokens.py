"""Token ids, token files and packing."""

import random
import zlib

import numpy as np
import pytest

from cohortlens.llm import packing, token_files, tokens
from cohortlens.llm.common import scratch

from .frames import edge_docs, edge_rows, no_docs


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.VOCABULARY)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


def test_texts_give_the_same_ids(plain):
    r = random.Random(1)
    odd = ["", " ", "  ", " a", "a ", "  a  b ", "a\n b", "it's  o'clock we'll ", "\x1c b \x85 c", "日本 語 text", "a\t b\t\tc   d\n\n e", " " * 300_000 + "b"]
    odd += ["".join(r.choice(" ab'1.\n\té  s!日\xa0") for _ in range(30)) for _ in range(500)]
    odd += ["".join(r.choice("etaoinshrdlucmfw ") for _ in range(200)) for _ in range(300)]
    odd += [t for _, t, *_ in edge_rows() if t]
    for x in odd:
        assert np.frombuffer(tokens.encoder().encode(x), "<u4").tolist() == plain(x), repr(x[:60])


def test_any_entries_in_a_row_give_the_same_ids(plain):
    r, entries = random.Random(3), []
    for x in tokens.encoder().ranks:
        try:
            entries.append(x.decode())
        except UnicodeDecodeError:
            pass
    for _ in range(20_000):
        x = "".join(r.choice(entries) for _ in range(r.randrange(1, 5)))
        assert tokens.encoder().ids(x) == plain(x), repr(x)


def test_added_tokens_give_the_same_ids(plain):
    ids = lambda x: np.frombuffer(tokens.encoder().encode(x), "<u4").tolist()
    assert 50256 in plain("a <|endoftext|> b")
    for x in ["a <|endoftext|> b", "<|endoftext|>", "it's<|endoftext|>é  b <|endoftext|", "a\ua7ce1\ua7ce.\ua7ce b", "x \u0558a \U000323b0b"]:
        assert ids(x) == plain(x), repr(x)
    assert 50256 not in tokens.encoder(plain_added=True).ids("a <|endoftext|> b")


def test_every_character_gives_the_same_ids(plain):
    e = tokens.encoder()
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]):
        text = f"{c}'s{c}"
        assert e.ids(text) == plain(text), hex(ord(c))


def test_other_vocabularies_go_to_their_library():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    assert tokens.encoder(path).fast is None
    assert tokens.encoder(path).ids("Some text") == Tokenizer.from_file(path).encode("Some text", add_special_tokens=False).ids


def test_files_round_trip(spark, plain):
    docs = edge_docs(spark)
    folder = scratch(spark, "test-tokens")
    manifest = token_files.write(docs, folder)
    rows = token_files.read(manifest).collect()
    want = sorted(((i is not None, i or 0), plain(t) + [2]) for i, t, *_ in edge_rows())
    got = sorted(rows, key=lambda r: r.start)
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == [(r.doc_id is not None, r.doc_id or 0) for r in got]
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted((len(ids), crc(ids)) for _, ids in want)
    # one document by its offset
    found = [dict(token_files.documents(p.path, {10})) for p in manifest.collect()]
    found = [x for x in found if x]
    assert len(found) == 1 and np.frombuffer(found[0][10], "<u4").tolist() == plain(dict((r[0], r[1]) for r in edge_rows())[10]) + [2]


def test_rows_that_are_all_alike_go_to_several_files(spark, plain):
    docs = spark.createDataFrame([(5, "some text " * 20)] * 200 + [(6, "end")], "doc_id long, text string")
    manifest = token_files.write(docs, scratch(spark, "test-alike"), file_bytes=8000).cache()
    assert manifest.count() >= 4 and max(r.n_docs for r in manifest.collect()) < 120
    rows = token_files.read(manifest).collect()
    n = len(plain("some text " * 20)) + 1
    assert sorted((r.start, r.n_tokens) for r in rows) == [(k * n, n) for k in range(200)] + [(200 * n, 2)]


def test_files_of_nothing(spark):
    assert token_files.round_trip(no_docs(spark)).collect() == []


@pytest.mark.parametrize("n,limit,want", [(1, 4, [(0, 1)]), (4, 4, [(0, 4)]), (9, 4, [(0, 1), (1, 4), (5, 4)]), (8, 4, [(0, 4), (4, 4)])])
def test_cuts(n, limit, want):
    assert list(packing.cuts(n, limit)) == want


def check_packing(rows, limit):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= limit
    return len(by_sequence)


def test_packs_edge_documents(spark, plain):
    rows = packing.pack_documents(edge_docs(spark)).collect()
    check_packing(rows, 2048)
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, t, *_ in edge_rows():
        if i in (None, 9):
            continue  # repeated ids
        ids, at = plain(t) + [0], 0
        for k, r in enumerate(sorted(by_doc[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (r.length == 2048 or k == 0)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at:at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert len(by_doc[9]) == 2 and len(by_doc[None]) == 2
    assert packing.pack_documents(no_docs(spark)).collect() == []


def test_rounds_pack_tightly(spark):
    r = random.Random(4)
    sizes = [r.choice([r.randrange(1, 200), r.randrange(200, 1100), 1024]) for _ in range(4000)]
    items = spark.createDataFrame([(k, 0, 0, n, 0) for k, n in enumerate(sizes)], packing._PIECES).repartition(16)
    rows = packing.sequences(items, fan_in=3).collect()
    assert sorted(x.doc_id for x in rows) == list(range(4000))
    assert check_packing(rows, 2048) <= 1.02 * sum(sizes) / 2048 + 1


def test_best_fit_takes_the_tightest_bin():
    bins, n = packing.best_fit(np.array([7, 6, 3, 4, 10]), 10)
    assert n == 3 and bins[2] == bins[0] and bins[3] == bins[1]


@pytest.mark.parametrize("round_items", [50, packing.ROUND_ITEMS])
def test_rounds_end_with_many_bins(spark, round_items):
    """Pieces of which no two fit together, and some that fill them up."""
    r = random.Random(6)
    sizes = [r.randrange(1030, 1500) for _ in range(900)] + [r.randrange(400, 700) for _ in range(300)]
    items = spark.createDataFrame([(k, 0, 0, n, 7) for k, n in enumerate(sizes)], packing._PIECES).repartition(16)
    rows = packing.sequences(items, round_items=round_items).collect()
    assert sorted((x.doc_id, x.length) for x in rows) == list(enumerate(sizes))
    n = check_packing(rows, 2048)
    assert 900 <= n <= (905 if round_items > 1000 else 960)
