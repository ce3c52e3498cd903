import random
import re

import pytest

from cohortlens.llm import decontaminate

from .frames import documents, edge_docs, no_docs, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(texts, items, window=10):
    tests = set()
    for name, text in items:
        w = words(text)
        n = min(window, len(w))
        tests |= {(tuple(w[k:k + n]), name) for k in range(len(w) - n + 1) if n}
    out = []
    for text in texts:
        w, hit, names = words(text), set(), set()
        for test, name in tests:
            for k in range(len(w) - len(test) + 1):
                if tuple(w[k:k + len(test)]) == test:
                    hit |= set(range(k, k + len(test)))
                    names.add(name)
        out.append((len(w), len(hit), sorted(names)))
    return out


def items_and_texts():
    r = random.Random(5)
    items = [(str(k), prose(100 + k, r.choice([1, 2, 3, 9, 10, 11, 30]))) for k in range(25)] + [("90", ""), ("91", prose(103, 30).upper())]
    texts = [None, "", "a"]
    for k in range(60):
        w = prose(k, 200).split()
        passage = items[r.randrange(len(items))][1].split()
        cut = passage[:r.randrange(1, len(passage) + 1)] if passage else []
        at = r.randrange(len(w))
        texts.append(r.choice([" ", "\n", ", ", "--"]).join(w[:at] + cut + w[at:] + cut))
    return items, texts


@pytest.mark.parametrize("block_windows", [1 << 17, 60])
def test_equals_brute_force(spark, block_windows):
    items, texts = items_and_texts()
    bench = spark.createDataFrame([(int(n), t) for n, t in items], "item_id long, text string")
    got = decontaminate.find_leaks(documents(spark, texts), bench, block_windows=block_windows).orderBy("doc_id").collect()
    want = brute(texts, items)
    assert [(r.n_words, sum(x.end - x.first for x in r.hit_words), list(r["items"])) for r in got] == want
    assert any(n for _, n, _ in want)
    for r in got:  # runs are apart and in order
        edges = [e for x in r.hit_words for e in (x.first, x.end)]
        assert edges == sorted(set(edges))


def test_awkward_cases(spark):
    docs = edge_docs(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    odd = spark.createDataFrame([(None, prose(3, 80)), (1, None), (1, "!!")], "item_id long, text string")
    assert not any(r["items"] for r in decontaminate.find_leaks(docs, none).collect())
    hit = {r.doc_id for r in decontaminate.find_leaks(docs, odd).collect() if r["items"] == ["null"]}
    assert hit == {13, 14, 15}
    left = decontaminate.without_leaks(docs, odd)
    assert left.columns == docs.columns and left.count() == docs.count() - 3
    assert decontaminate.find_leaks(no_docs(spark), odd).collect() == []


@pytest.mark.parametrize("block_windows", [1 << 17, 8])
def test_rows_that_share_an_id_are_judged_by_text(spark, block_windows):
    leak, clean = prose(1, 30), prose(2, 30)
    docs = spark.createDataFrame([(None, leak), (None, clean), (None, None), (5, leak), (5, clean), (6, clean)], "doc_id long, text string")
    bench = spark.createDataFrame([("a", leak), ("b", prose(3, 30))], "item_id string, text string")
    left = decontaminate.without_leaks(docs, bench, block_windows=block_windows).collect()
    assert sorted(map(str, left)) == sorted(map(str, docs.where("text IS NULL OR text = '" + clean + "'").collect()))
