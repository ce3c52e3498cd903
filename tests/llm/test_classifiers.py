"""Toxicity and language identification."""

import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from cohortlens.llm import language_id, toxicity

from .frames import edge_docs, no_docs, prose


def test_toxicity_learns_and_holds_out(spark):
    r = random.Random(2)
    rows = []
    for k in range(700):
        toxic = k % 4 == 0
        words = prose(k, r.randrange(20, 120)).split()
        if toxic:
            words[r.randrange(len(words))] = r.choice(["Grumblefool", "you rotter"])
        rows.append((k, " ".join(words), int(toxic)))
    rows += [(9000, None, 1), (9001, "", 0), (9002, "text", None), (None, "null id", 1)]
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = {x.doc_id: x for x in toxicity.classify(data.select("doc_id", "text"), data.select("doc_id", "toxic")).collect()}
    assert len(got) == len(rows)
    assert all(x.held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, x in got.items() if k is not None)
    assert all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got.values())
    held = [(got[k].predicted, y) for k, _, y in rows[:700] if got[k].held_out]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    assert got[9000].score == got[9001].score < 0.5


def test_features_equal_brute_force():
    import pyarrow as pa

    texts = ["A b c", "", "x", "b C d a b c"]
    ((count, row, at),) = toxicity._by_text(pa.array(texts))
    assert count == 4
    sets = [set(at[row == k].tolist()) for k in range(4)]
    assert [len(s) for s in sets] == [6, 0, 1, 12] and sets[0] <= sets[3]


def test_awkward_toxicity(spark):
    docs = edge_docs(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.classify(docs, none).collect()
    assert len(rows) == docs.count() and all(r.score == 0.5 for r in rows)
    assert toxicity.classify(no_docs(spark), none).collect() == []


def test_forward_sums_all_segmentations():
    table = language_id.pieces()
    r = np.random.default_rng(1)
    p = r.random((language_id.n_pieces(), 2))
    p /= p.sum(0)
    words = ["the", "ünder", "a", "日本x", "straße"]
    got = language_id.Lattice([w.encode() for w in words]).log_probabilities(p)
    known = lambda x: table[x] if table.get(x, -1) > 0 else 0 if len(x) == 1 else None
    for w, logs in zip(words, got, strict=True):
        t, total = "▁" + w, np.zeros(2)
        for cuts in itertools.product([False, True], repeat=len(t) - 1):
            edges = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(t)]
            parts = [t[a:b] for a, b in itertools.pairwise(edges)]
            numbers = [known(x) for x in parts]
            if None not in numbers:
                total += np.prod(p[numbers], axis=0)
        assert np.allclose(logs, np.log(total))


def test_long_words_are_summed_whole(monkeypatch):
    """A word of 60 letters, taken by itself, as if all words were as long."""
    r = np.random.default_rng(2)
    p = r.random((language_id.n_pieces(), 3))
    p /= p.sum(0)
    words = [("donaudampfschifffahrt" * 3)[:60].encode(), b"the", ("日本語" * 12).encode()]
    table, lattice = language_id.pieces(), language_id.Lattice(words)
    assert [k for k, _ in lattice.long] == [0, 2]
    for w, logs in zip(words, lattice.log_probabilities(p), strict=True):
        t = "▁" + w.decode()
        f = [np.ones(3)] + [np.zeros(3) for _ in t]
        for end in range(1, len(t) + 1):
            for a in range(end):
                k = table.get(t[a:end], -1)
                if k > 0 or end - a == 1:
                    f[end] = f[end] + f[a] * p[max(k, 0)]
        assert np.allclose(logs, np.log(f[-1]))
    counts = np.array([[2.0, 0, 1], [1, 1, 1], [0, 3, 0]])
    got = lattice.expected(p, counts)
    monkeypatch.setattr(language_id, "LONGEST_WORD", 2)  # all words by themselves
    assert np.allclose(language_id.Lattice(words).expected(p, counts), got)
    far = language_id.Lattice([b"x" * 20_000]).log_probabilities(p)
    assert np.isfinite(far).all() and (far < -10_000).all()


def test_texts_between_languages_are_not_kept(spark):
    rows = [(k, prose(k, 60), "en") for k in range(30)] + [(100 + k, prose(k, 60)[::-1], "xx") for k in range(30)]
    docs = spark.createDataFrame([*rows, (900, "zzz qqq 1", None), (901, "123", None)], "doc_id long, text string, lang string")
    scores = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    for share in (0.5, 0.999999):
        kept = {r.doc_id for r in language_id.known_languages(docs, least_share=share).collect()}
        assert kept == {k for k, (lang, score) in scores.items() if lang != "und" and score >= share}


def test_expected_counts_equal_brute_force():
    table = language_id.pieces()
    p = np.full((language_id.n_pieces(), 1), 1e-3)
    t = "▁the"
    want, total = {}, 0.0
    for cuts in itertools.product([False, True], repeat=len(t) - 1):
        edges = [0, *(k + 1 for k, c in enumerate(cuts) if c), len(t)]
        parts = [t[a:b] for a, b in itertools.pairwise(edges)]
        if all(table.get(x, -1) > 0 for x in parts):
            chance = math.prod([1e-3] * len(parts))
            total += chance
            for x in parts:
                want[table[x]] = want.get(table[x], 0) + chance
    got = language_id.Lattice([b"the"]).expected(p, np.array([[5.0]]))[:, 0]
    assert np.allclose([got[k] for k in want], [5 * v / total for v in want.values()]) and np.isclose(got.sum(), sum(5 * v / total for v in want.values()))


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert len(got) > 20 and sum(r.lang == r.lang_pred for r in got) / len(got) > 0.95
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and 0 <= r.score <= 1 for r in got)


def test_awkward_languages(spark):
    docs = edge_docs(spark)
    rows = language_id.identify(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[k].lang_pred == "und" and by_id[k].score == 0 for k in (1, 2, 3, 12))
    assert by_id[6].lang_pred in ("de", "en", "fr")
    left = language_id.known_languages(docs)
    assert left.columns == docs.columns and left.count() == docs.count() - 5
    unknown = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unknown} == {"und"}
    assert language_id.identify(no_docs(spark)).collect() == []


def test_toxicity_sample_is_bounded_with_copies(spark):
    rows = [("a hot text", 1)] * 600 + [(f"text number {k}", k % 2) for k in range(300)]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(rows)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, (_, y) in enumerate(rows)], "doc_id long, label int")
    distinct = toxicity.labelled(docs, labels)
    got = toxicity.training_features(docs, toxicity.sample(distinct, 400)).collect()
    assert sorted((r.label, r.n) for r in got) == sorted([(1, 600)] + [(k % 2, 1) for k in range(300)])
    hot = next(r for r in got if r.n == 600)
    (_, _, at), = toxicity._by_text(pa.array(["a hot text"]))
    assert np.frombuffer(hot.features, "<i4").tolist() == sorted(set(at.tolist()))
    assert toxicity.sample(distinct, 100).count() == 100


def test_ids_repeated_on_both_sides_are_counted_not_multiplied(spark):
    docs = spark.createDataFrame([(1, "a b")] * 40 + [(1, "c d")] * 3 + [(None, "e"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)] * 50 + [(1, 0)] * 2 + [(None, 1), (2, 1)], "doc_id long, label int")
    assert sorted((r.label, r.n) for r in toxicity.labelled(docs, labels).collect()) == [(0, 6), (0, 80), (1, 150), (1, 2000)]


def test_learning_equals_a_plain_loop():
    """FTRL-proximal, coordinate by coordinate, in plain Python."""
    r = random.Random(4)
    documents = [np.array(sorted(r.sample(range(40), 6))) for _ in range(60)]
    labels = np.array([float(d.min() < 8) for d in documents])
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= toxicity.L1:
            return 0.0
        return -(zi - math.copysign(toxicity.L1, zi)) / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2)

    order = np.random.default_rng(7)
    for _ in range(20):
        for k in order.permutation(len(documents)).tolist():
            w = {i: weight(i) for i in documents[k].tolist()}
            g = 1 / (1 + math.exp(-sum(w.values()))) - labels[k]
            if abs(g) < 1e-3:
                continue
            for i, wi in w.items():
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * wi
                n[i] = n.get(i, 0.0) + g * g
    got = toxicity.learn(documents, labels, 20)
    want = np.array([weight(i) for i in range(40)])
    assert want.any() and np.allclose(got[:40], want) and not got[40:].any()


def test_copies_teach_as_often():
    documents, labels = [np.array([1, 2]), np.array([2, 3]), np.array([4])], np.array([1.0, 0.0, 1.0])
    once = toxicity.learn(documents, labels, 1)
    often = toxicity.learn(documents, labels, 1, np.array([1, 1, 30]))
    assert once[4] == 0 and often[4] > 0 and (toxicity.learn(documents, labels, 1, np.ones(3, int)) == once).all()


def test_languages_are_learnt_with_many_copies(spark):
    few = [(f"{prose(k, 12)} stone", "en") for k in range(40)]
    other = [("der hund schläft nicht hier " + "abcdefgh"[k % 8] * (k + 1), "de") for k in range(40)]
    hot = [("zzz qqq zzz", "en")]
    plain, alone, copied = (spark.createDataFrame(few + other + x, "text string, lang string") for x in ([], hot, hot * 4000))
    a, b = (language_id.train(x, training_texts=41, rounds=1) for x in (alone, copied))
    assert a.languages == b.languages and np.allclose(a.p, b.p)
    assert not np.allclose(language_id.train(plain, training_texts=41, rounds=1).p, b.p)
