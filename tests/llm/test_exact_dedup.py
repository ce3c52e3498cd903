import hashlib
import re
from collections import defaultdict

from cohortlens.llm import exact_dedup

from .frames import edge_docs, edge_rows, no_docs


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def test_groups_equal_brute_force(spark):
    want = defaultdict(list)
    for i, text, *_ in edge_rows():
        want[squeezed(text)].append(i)
    got = exact_dedup.copy_groups(edge_docs(spark), digest_all=True).collect()
    assert len(got) == len(edge_rows())
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in want.items()}
    kept = defaultdict(int)
    for r in got:
        ids = by_digest[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.keep_id == (min(known) if known else None)
        assert r.group_size == len(ids)
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}


def test_lone_rows_are_not_hashed(spark):
    rows = exact_dedup.copy_groups(edge_docs(spark)).collect()
    lone = [r for r in rows if r.group_size == 1]
    assert lone and all(r.text_sha256 is None for r in lone)


def test_filter_keeps_columns(spark):
    docs = edge_docs(spark)
    left = exact_dedup.without_copies(docs)
    assert left.columns == docs.columns
    texts = [squeezed(r.text) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({squeezed(t) for _, t, *_ in edge_rows()})


def test_empty(spark):
    assert exact_dedup.copy_groups(no_docs(spark)).collect() == []
    assert exact_dedup.without_copies(no_docs(spark)).collect() == []
