import hashlib
import random

import numpy as np
import pytest

from cohortlens.llm import repeats

from .frames import documents, edge_docs, edge_rows, no_docs, prose


def varied(length):
    r = random.Random(11)
    shared = [prose(900 + k, 40)[:r.choice([length - 1, length, length + 1, 3 * length])] for k in range(5)]
    texts = [None, "", "ab" * length, "é" * length, "z" * (length - 1)]
    for k in range(40):
        texts.append(prose(k, 20) + "".join(r.choice([r.choice(shared), prose(r.randrange(5000), 10)]) for _ in range(4)) + prose(k + 99, 20))
    return [*texts, texts[7], texts[9] + "x"]


@pytest.mark.parametrize("hot", [4096, 1])
def test_equals_brute_force(spark, hot):
    texts = varied(40)
    docs = documents(spark, texts)
    got = {r.doc_id: r for r in repeats.without_repeats(docs, length=40, key=20, hot_classes=hot).collect()}
    raw = [(t or "").encode() for t in texts]
    for k, (runs, digest) in enumerate(repeats.brute_force(raw, 40)):
        assert [(x.begin, x.end) for x in got[k].removed] == runs, k
        assert hashlib.sha256(got[k].kept).hexdigest() == digest
        assert got[k].n_bytes == len(raw[k])


def test_first_of_equal_strings_stays(spark):
    a, b, c = prose(1, 30), prose(2, 30), prose(3, 30)
    docs = documents(spark, [a + b, c + a, b, b])
    got = [bytes(r.kept).decode() for r in repeats.without_repeats(docs, length=40, key=20, keep_first=True).orderBy("doc_id").collect()]
    assert got[0] == a + b and got[1].startswith(c[:-40]) and a[:50] not in got[1] and got[2:] == ["", ""]


def test_awkward_cases(spark):
    docs = edge_docs(spark)
    rows = repeats.without_repeats(docs).collect()
    raw = [(t or "").encode() for _, t, *_ in edge_rows()]
    want = sorted((i is None, i or 0, len(t), digest) for (i, *_), t, (_, digest) in zip(edge_rows(), raw, repeats.brute_force(raw, 400), strict=True))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, hashlib.sha256(r.kept).hexdigest()) for r in rows) == want
    assert repeats.without_repeats(no_docs(spark)).collect() == []


def test_factor_arrays_equal_brute_force():
    import numpy as np

    r = random.Random(8)
    n, span = 60, 8
    contexts = [(bytes(r.choice(b"ab") for _ in range(r.choice([span, span, 3]))), bytes(r.choice(b"ab") for _ in range(r.choice([span, span, 5]))))
                for _ in range(n)]
    group = np.array([r.randrange(3) for _ in range(n)])
    rows = lambda parts: np.array([list(p.ljust(span, b"\0")) for p in parts], np.uint8)
    before, after = rows([a[::-1] for a, _ in contexts]), rows([b for _, b in contexts])
    left, right = np.array([len(a) for a, _ in contexts]), np.array([len(b) for _, b in contexts])
    earlier, later = repeats.factor_matches(before, after, left, right, group, np.arange(n))
    for s in range(span + 1):
        strings = [(g, a[len(a) - s:], b[:span - s]) if len(a) >= s and len(b) >= span - s else None
                   for g, (a, b) in zip(group, contexts, strict=True)]
        for k, x in enumerate(strings):
            assert earlier[s, k] == (x is not None and x in strings[:k])
            assert later[s, k] == (x is not None and x in strings[k + 1:])


def test_smaller_neighbours_equal_a_scan():
    r = np.random.default_rng(1)
    for _ in range(200):
        n = int(r.integers(1, 40))
        run = np.sort(r.integers(0, 5, n))
        values = r.permutation(n) if r.random() < 0.5 else r.integers(0, 6, n)
        before, after = repeats.smaller_neighbours(values, run)
        for i in range(n):
            left = [j for j in range(i) if run[j] == run[i] and values[j] < values[i]]
            right = [j for j in range(i + 1, n) if run[j] == run[i] and values[j] < values[i]]
            assert before[i] == max(left, default=-1) and after[i] == min(right, default=-1)


def test_stretches_change_no_anchor(monkeypatch):
    r = np.random.default_rng(2)
    row = r.integers(97, 100, 9000).astype(np.uint8)
    row[5000:6500] = row[1000:2500]
    offsets = np.array([0, 4000, 9000])
    whole = repeats.anchors(row, offsets, 60, 20)
    monkeypatch.setattr(repeats, "PLACE_BITS", 10)
    cut = repeats.anchors(row, offsets, 60, 20)
    places = {int(x) + (0 if k == 0 else 4000) for k, x in zip(cut[0], cut[1], strict=True)}
    # every string has its anchor, and equal strings have it at one place within them
    assert len(whole[0]) and all(any(x <= p <= x + 40 for p in places) for x in [*range(0, 3940, 7), *range(4000, 8940, 7)])
    assert {p - 1000 for p in places if 1060 <= p < 2400} == {p - 5000 for p in places if 5060 <= p < 6400}
