"""Periodic runs against a brute-force search."""

import hashlib
import random
import zlib

import pytest

from cohortlens.llm import periodic

from .frames import documents, edge_docs, edge_rows, no_docs


def brute_runs(words, shortest=12):
    """All maximal stretches of each smallest period, from the definition."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(shortest, 2 * q):
                part = words[i:i + length]
                if not any(all(part[k] == part[k + p] for k in range(length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_planted(doc, text):
    words = (text or "").encode().split()
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if doc is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def brute_collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


@pytest.mark.parametrize("shortest", [2, 3, 6, 12])
def test_runs_equal_brute_force(shortest):
    r = random.Random(shortest)
    texts = [[b"a"] * 30, [b"a", b"b"] * 20, [b"a", b"a", b"b"] * 9 + [b"a"] * 14, [], [b"x"]]
    for _ in range(300):
        n, letters = r.randrange(1, 60), b"ab" if r.random() < 0.5 else b"abcdef"
        words = [bytes([r.choice(letters)]) for _ in range(n)]
        for _ in range(r.randrange(3)):  # plant repeats, also one within another
            a = r.randrange(n)
            p = r.randrange(1, 9)
            words[a:a + 4 * p] = (words[a:a + p] * 4)[:len(words[a:a + 4 * p])]
        texts.append(words)
    assert periodic.document_runs(texts, shortest) == [brute_runs(w, shortest) for w in texts]


def test_fibonacci_words_and_nested_powers():
    a, b = [b"a"], [b"a", b"b"]
    for _ in range(9):
        a, b = b, b + a
    nested = (([b"x"] * 13 + [b"y"]) * 3 + [b"z"]) * 2
    assert periodic.document_runs([b, nested], 12) == [brute_runs(b), brute_runs(nested)]


def check(rows, want):
    got = sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.collapsed_sha256, r.n_runs))
    lines = []
    for doc, text in want:
        words = brute_planted(doc, text)
        found = brute_runs(words) if len(words) < 5000 else periodic.document_runs([words])[0]
        kept = brute_collapsed(words, found)
        best = min(found, key=lambda x: (-x[1], x[0], x[2])) if found else (None, None, None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        lines.append((doc, len(found), *best, 1000 * best[1] // best[2] if found else None,
                      hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    lines.sort(key=lambda x: (x[0] is None, x[0] or 0, x[-1], x[1]))
    assert [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in got] == lines


def test_documents(spark):
    r = random.Random(3)
    texts = [" ".join(r.choice("ab") for _ in range(r.randrange(80))) for _ in range(150)] + ["a\tb\x0bc\x0cd\re " * 9, "é\xa0é " * 15, "\x1ca \x85 " * 12]
    check(periodic.run_digests(periodic.find_runs(documents(spark, texts), planted=True)).collect(), list(enumerate(texts)))


def test_edge_documents(spark):
    check(periodic.run_digests(periodic.find_runs(edge_docs(spark), planted=True)).collect(), [(i, t) for i, t, *_ in edge_rows()])
    assert periodic.run_digests(periodic.find_runs(no_docs(spark))).collect() == []


def test_slices_change_nothing(spark, monkeypatch):
    texts = [" ".join("abcab"[k % (2 + j % 4)] for k in range(40 + j)) for j in range(30)]
    whole = periodic.document_runs([t.encode().split() for t in texts])
    monkeypatch.setattr(periodic, "SLICE_WORDS", 50)
    rows = periodic.find_runs(documents(spark, texts)).collect()
    assert {r.doc_id: [tuple(x) for x in r.runs] for r in rows} == dict(enumerate(whole))
