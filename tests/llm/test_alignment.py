"""Alignment of two tokenizers against all pairs of tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cohortlens.llm import alignment, tokens

from .frames import documents, edge_docs, edge_rows, no_docs, prose


def ranges(pieces):
    at, out = 0, []
    for k, data in pieces:
        out.append((k, at, at + len(data)))
        at += len(data)
    return out


@pytest.fixture(scope="module")
def both():
    """(A, B) tokens with their bytes by the libraries themselves."""
    import sentencepiece
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.VOCABULARY)
    t.encode_special_tokens = True
    letters = {c: b for b, c in tokens.byte_letters().items()}
    s = sentencepiece.SentencePieceProcessor(model_file=alignment.B_MODEL)

    def of(text):
        if not text:
            return [], []
        a = [(k, bytes(letters[c] for c in t.id_to_token(k))) for k in t.encode(" " + text, add_special_tokens=False).ids]
        b = [(k, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode())
             for k, p in ((k, s.id_to_piece(k)) for k in s.encode(text))]
        data = (" " + text).encode()
        if b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
            return [], []
        return ranges(a), ranges(b)

    return of


def brute(texts, both):
    found = []
    for text in texts:
        a, b = both(text)
        links = [(i, j) for i, _, e in a for j, _, f in b if e == f] if len(a) * len(b) < 1e6 else \
            [(i, j) for e, i, j in ((e, dict((z, i) for i, _, z in a)[e], j) for j, _, e in b if e in {z for _, _, z in a})] if len(a) < 3000 else None
        if links is None:
            at = {e: i for i, _, e in a}
            links = [(at[e], j) for j, _, e in b if e in at]
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low, p, q = [], 0, 0, 0
        for end in ends:
            x, y = [], []
            while p < len(a) and a[p][2] <= end:
                x.append(str(a[p][0]))
                p += 1
            while q < len(b) and b[q][2] <= end:
                y.append(str(b[q][0]))
                q += 1
            groups.append(",".join(x) + "|" + ",".join(y))
            low = end
        assert not a or low == a[-1][2]
        found.append((len(a), len(b), len(groups), links, ";".join(groups)))
    counts = Counter(x for f in found for x in f[3])
    most = Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [(na, nb, g, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(t.encode()).hexdigest() if t else "") for na, nb, g, links, t in found]


def rows_of(table):
    return [(r.n_a, r.n_b, r.n_groups, len(r.links), r.n_best, r.count_sum, r.groups) for r in table]


def test_documents(spark, both):
    r = random.Random(5)
    odd = ["", None, " ", "a", " a", "a  b", "a\n\tb", "<|endoftext|>", "x <|endoftext|> y</s><s><unk>", "▁x y", "日本語のテキスト", "é\xa0ü ñandú",
           "🙂🙃 emoji", "\u0000 nul", "ﬁ ligature Ⅷ", "x՘y", "'ll we'll", "https://example.org/a_b?c=1", "\r\n", "a ​ b", "é"]
    odd += ["".join(r.choice(" ab'1.\n\té  sé日🙂xyz") for _ in range(40)) for _ in range(150)]
    odd += [prose(k, 40) for k in range(30)]
    got = sorted(alignment.link_table(documents(spark, odd), digest=True).collect(), key=lambda x: x.doc_id)
    assert rows_of(got) == brute(odd, both)


def test_edge_documents(spark, both):
    rows = edge_rows()
    got = alignment.link_table(edge_docs(spark), digest=True).collect()
    want = brute([t for _, t, *_ in rows], both)
    assert sorted((r.doc_id is not None, r.doc_id or 0, x) for r, x in zip(got, rows_of(got), strict=True)) == \
        sorted((i is not None, i or 0, x) for (i, *_), x in zip(rows, want, strict=True))
    assert alignment.link_table(no_docs(spark)).collect() == []


def test_overlaps_are_all_pairs_that_share_a_byte():
    r = random.Random(1)
    for _ in range(100):
        cut = [[sorted(r.sample(range(1, 20), r.randrange(6))) for _ in range(4)] for _ in range(2)]
        sides = []
        for docs in cut:
            starts = [np.array([20 * d, *(20 * d + k for k in c)]) for d, c in enumerate(docs)]
            start = np.concatenate(starts)
            sides.append(alignment.pd.DataFrame({"doc": np.repeat(range(4), [len(s) for s in starts]), "id": 0, "start": start, "end": np.append(start[1:], 80)}))
        got = alignment.overlaps(*sides)
        a, b = (list(zip(s["start"], s["end"], strict=True)) for s in sides)
        want = {(i, j) for i, (p, q) in enumerate(a) for j, (x, y) in enumerate(b) if max(p, x) < min(q, y)}
        assert len(got) == len(want) and set(zip(got["a"], got["b"], strict=True)) == want


def test_pair_bound_counts_endings():
    a, b = [b"a", b"ba", b"", b"xyz"], [b"a", b"cba", b"z", b"ba"]
    ends = sum(1 for x in a for y in b if x and y and (x.endswith(y) or y.endswith(x)))
    assert alignment.pair_bound(a, b) == ends
    kit = alignment.tokenizers()
    assert alignment.pair_bound(kit.a.entries, kit.b.entries) < 1_000_000
