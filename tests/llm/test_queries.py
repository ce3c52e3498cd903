"""Registered queries against their oracles and the pipeline against a version
without Spark."""

import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from cohortlens.llm import language_id
from cohortlens.llm.queries import ORACLE_SQL, QUERIES
from tools.compare import frame_rows

from ..conftest import SMALL
from .test_decontaminate import brute as leaks
from .test_near_dedup import brute as groups


def test_all_are_registered():
    names = entry.queries()
    assert {re.match(r"op(\d+)_", q)[1] for q in QUERIES} == {str(k) for k in range(1, 14)}
    assert set(QUERIES) <= set(names) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SMALL)
    got = pd.DataFrame([r.asDict() for r in df.collect()], columns=df.columns)
    want = con.sql(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert frame_rows(got) == frame_rows(want)


def test_pipeline_equals_plain_version(spark):
    docs = pd.read_parquet(f"{SMALL}/documents.parquet")
    bench = pd.read_parquet(f"{SMALL}/benchmark.parquet")
    langs = {r.doc_id for r in language_id.identify(spark.read.parquet(f"{SMALL}/documents.parquet")).where(
        "lang_pred <> 'und' AND score >= 0.5").collect()}  # the model has tests of its own
    kept = docs[[i in langs and bool(re.search(r"[^\W\d_]", t or "")) for i, t in zip(docs.doc_id, docs.text, strict=True)]]
    assert len(kept) == len(langs) > 0.9 * len(docs)
    kept = kept.assign(norm=[re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for t in kept.text]).sort_values("doc_id").drop_duplicates("norm")
    near = groups(list(kept.text), 5)
    kept = kept[[c == k for k, (_, c) in enumerate(near)]]
    hit = leaks(list(kept.text), [(str(i), t) for i, t in zip(bench.item_id, bench.text, strict=True)])
    kept = kept[[not names for _, _, names in hit]]
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id for r in rows} == set(kept.doc_id)
    fills = Counter()
    for r in rows:
        fills[r.sequence_id] += r.length
    assert max(fills.values()) <= 2048 and len(fills) <= 1.05 * np.ceil(sum(fills.values()) / 2048) + 1
