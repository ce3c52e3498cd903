import random

import numpy as np
import pytest

from cohortlens.llm import near_dedup
from cohortlens.llm.components import components

from .frames import documents, edge_docs, no_docs, prose


def brute(texts, n, percent=80):
    sets = [near_dedup.shingles((t or "").encode(), n) for t in texts]
    part = list(range(len(texts)))

    def root(a):
        while part[a] != a:
            a = part[a]
        return a

    for i, x in enumerate(sets):
        for j in range(i):
            common = len(x & sets[j])
            if x and sets[j] and 100 * common >= percent * (len(x) + len(sets[j]) - common):
                a, b = sorted((root(i), root(j)))
                part[b] = a
    return [(len(x), root(i)) for i, x in enumerate(sets)]


def varied():
    r = random.Random(3)
    texts = [None, "", " ", "one", "One", "one two", "ONE\ttwo"]
    for family in range(6):
        w = prose(family, r.choice([12, 60, 250])).split()
        for _ in range(12):
            w = [x if r.random() > 0.03 else "new%d" % r.randrange(999) for x in w]  # a chain of changes
            texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize("shingle,block", [(2, 1024), (5, 1024), (2, 3)])
def test_equals_brute_force(spark, shingle, block):
    texts = varied()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_groups(documents(spark, texts), shingle=shingle, block=block).collect()}
    want = brute(texts, shingle)
    assert [got[k] for k in range(len(texts))] == want
    assert len({c for _, c in want}) < len(texts) - 20


def test_awkward_cases(spark):
    docs = edge_docs(spark)
    rows = near_dedup.near_groups(docs).collect()
    assert len(rows) == docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by_id[k].n_shingles for k in (1, 2, 3, 4, 5)] == [0, 0, 0, 1, 1]
    assert by_id[7].component_id == by_id[8].component_id == by_id[9].component_id == 6
    assert by_id[15].component_id == 13 and by_id[11].component_id == 11
    assert sorted((r.component_id is None, r.kept) for r in rows if r.doc_id is None) == [(False, False), (True, True)]
    left = near_dedup.without_near_copies(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {None, 1, 2, 3, 4, 5, 6, 10, 11, 12, 13, 14}
    assert near_dedup.near_groups(no_docs(spark)).collect() == []


def test_rows_that_share_an_id_are_judged_by_text(spark):
    a, b, c, d = (prose(k, 100) for k in range(4))
    rows = [(3, a), (5, a + " more"), (5, b), (None, c), (None, c + " more"), (None, c + " more"), (None, d), (None, d), (None, None), (None, None), (7, c + " again"), (8, d.upper().lower()), (9, "x y"), (9, "x y")]
    rows += [(None, prose(9, 100)), (None, prose(9, 100) + " more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [(r.doc_id, r.text) for r in near_dedup.without_near_copies(docs).collect()]
    lone = [r for r in left if r in rows[-2:]]
    assert len(lone) == 1
    left.remove(lone[0])
    assert sorted(map(str, left)) == sorted(map(str, [(3, a), (5, b), (7, c + " again"), (8, d), (9, "x y"), (None, None), (None, None)]))
    found = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_groups(docs).collect()}
    assert (5, 3, False) in found and (5, 5, True) in found and (None, 7, False) in found and (None, None, True) in found


def test_components_of_chain_star_and_cycle(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(8, 40)] + [(50, 51), (51, 52), (52, 50)] + [(60, 60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(100, 161)} | {k: 7 for k in range(7, 40)} | {50: 50, 51: 50, 52: 50}


def test_pairs_short_of_the_threshold_by_hash_hide_nothing():
    """What isn't surely similar is handed on, and joins nothing."""
    sets = [np.arange(n, dtype=np.uint64) for n in (100, 79, 80)] + [np.arange(500, 600, dtype=np.uint64)]
    pairs = lambda found, wanted: {(min(a, b), max(a, b)) for a, b, similar in found if similar in wanted}
    for joining in (True, False):
        found = near_dedup.compare_block([1, 2, 3, 4], [1, 2, 3, 4], [0] * 4, sets, 80, joining)
        assert pairs(found, (False,)) == {(1, 2)} and pairs(found, (True,)) == {(1, 3), (2, 3)}
    # three that are alike: two links join them, and without joining all three are found
    same = [np.arange(50, dtype=np.uint64)] * 3
    assert len(near_dedup.compare_block([1, 2, 3], [1, 2, 3], [0] * 3, same, 80)) == 2
    assert len(near_dedup.compare_block([1, 2, 3], [1, 2, 3], [0] * 3, same, 80, joining=False)) == 3


def test_a_family_below_the_threshold_stays_apart(spark):
    """A template that all share for 0.6 to 0.75, so that they meet in many buckets."""
    r = random.Random(8)
    template = prose(5, 70).split()
    texts = []
    for k in range(120):
        words = list(template)
        at = r.randrange(50)
        words[at:at + 8 + k % 5] = [f"w{k}x{j}" for j in range(8 + k % 5)]
        texts.append(" ".join(words))
    texts += [texts[3] + " tail", texts[7] + " tail"]
    rows = near_dedup.near_groups(documents(spark, texts)).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in rows) == [(k, n, c) for k, (n, c) in enumerate(brute(texts, 2))]
