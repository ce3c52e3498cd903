"""The registered queries of the operators and their oracle SQL.

Each query reads the whole tables of ``sf_dir`` with production parameters and
derives the digest columns from its operator's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    byte_bpe,
    decontaminate,
    exact_dedup,
    extraction,
    language_id,
    near_dedup,
    packing,
    periodic,
    repeats,
    token_files,
    toxicity,
    warc,
)
from .common import read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_leaks(read(spark, sf_dir, "documents").select("doc_id", "text"),
                                     read(spark, sf_dir, "benchmark").select("item_id", "text"))
    n_hit = F.aggregate("hit_words", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["first"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        (F.size("items") > 0).alias("contaminated"))


ORACLE_SQL["op1_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
tests AS (
  SELECT DISTINCT item_id, len(w[p:p + least(10, len(w)) - 1]) AS n, array_to_string(w[p:p + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS p FROM b WHERE len(w) > 0)),
places AS (
  SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS p
        FROM d, (SELECT DISTINCT n FROM tests) WHERE len(w) >= n)),
found AS (SELECT doc_id, p, n, item_id FROM places JOIN tests USING (n, s)),
hits AS (SELECT doc_id, count(DISTINCT k) AS n_hit
         FROM (SELECT doc_id, unnest(generate_series(p, p + n - 1)) AS k FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS l
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM found) GROUP BY doc_id)
SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(l, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(read(spark, sf_dir, "documents").select("doc_id", "text"),
                             read(spark, sf_dir, "labels").select("doc_id", "toxic"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


@query
def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_groups(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(read(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["begin"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("url")


ORACLE_SQL["op8_warc"] = """
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND first < page_id THEN first END AS refers_to
FROM f
"""


@query
def op9_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = extraction.extract(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.copy_groups(docs, digest_all=True)


ORACLE_SQL["op10_exact_dedup"] = r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM n WINDOW w AS (PARTITION BY text_sha256)
"""


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignment.link_table(read(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)
    return rows.select("doc_id", "n_a", "n_b", "n_groups", F.size("links").cast("long").alias("n_links"), "n_best", "count_sum",
                       F.col("groups").alias("groups_sha256"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(periodic.find_runs(read(spark, sf_dir, "documents").select("doc_id", "text"), planted=True))


@query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = byte_bpe.decode(byte_bpe.encode(read(spark, sf_dir, "documents").select("doc_id", "text")))
    return rows.select("doc_id", F.expr("cast(length(ids) div 4 as long)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))
