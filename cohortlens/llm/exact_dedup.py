"""Exact deduplication by progressive refinement (DataFrame functions only).

Texts are equal when they are identical after each run of ASCII white space
became one space; a null text counts as empty.

1. Every text is reduced to its length and the hash of its first characters.
2. Rows are counted by length, then, where a length occurs again, by (length,
   prefix hash). Both counts go to a fixed number of buckets, so that the list
   of crowded buckets has a proven size and can be broadcast. Two keys in one
   bucket only mean that a row is read once more than needed.
3. Rows of crowded buckets are read again in full and hashed (SHA-256 of the
   whole normalised text) where they lie: no text is ever shuffled. Equal
   hashes are the groups.

Counts combine in the mapping tasks, so a text that makes up a third of all
rows reaches the shuffle as few rows; where members meet their group, adaptive
execution splits the hot key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import split_by_ids, stored

#: Characters whose hash makes the second refinement.
PREFIX_CHARS = 64
#: Buckets of a refinement, and so the most rows of its broadcast list.
SIEVE_BUCKETS = 1 << 20


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _crowded(rows: DataFrame, bucket: Column, name: str) -> DataFrame:
    """Buckets that more than one row falls into (at most SIEVE_BUCKETS)."""
    return F.broadcast(rows.groupBy(bucket.alias(name)).agg(F.count(F.lit(1)).alias("_n"))
                       .where("_n > 1").select(name, F.lit(True).alias(f"{name}_again")))


def copy_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                prefix_chars: int = PREFIX_CHARS, digest_all: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep_id`` is the smallest id among equal texts (null only if all of them
    are null) and ``group_size`` their number of rows. ``kept`` is true for
    exactly one row of each group; of rows that repeat the same id and text,
    for one. Null and empty texts are equal to each other; an empty table gives
    an empty result; further columns are ignored, whatever their names.
    ``text_sha256`` is null for rows that the first refinements found to be
    alone, unless ``digest_all`` asks for the hash of every row."""
    text = normalised(F.col(text_col))
    length, prefix = F.octet_length(text), F.xxhash64(F.substring(text, 1, prefix_chars))
    keys = stored(docs.select(length.alias("_len"), prefix.alias("_prefix")), "exact-keys")
    by_length = F.pmod(F.col("_len").cast("long"), F.lit(SIEVE_BUCKETS))
    by_prefix = F.pmod(F.xxhash64("_len", "_prefix"), F.lit(SIEVE_BUCKETS))
    lengths = _crowded(keys, by_length, "_l")
    prefixes = _crowded(keys.withColumn("_l", by_length).join(lengths, "_l", "left_semi"), by_prefix, "_p")

    suspect = F.col("_p_again").isNotNull()
    content = F.sha2(F.encode("_text", "UTF-8"), 256)
    rows = stored(
        docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"), length.alias("_len"), prefix.alias("_prefix"))
        .withColumn("_p", by_prefix).join(prefixes, "_p", "left")
        .select("doc_id", suspect.alias("_suspect"),
                (content if digest_all else F.when(suspect, content)).alias("text_sha256")), "exact-rows")

    alone = rows.where(~F.col("_suspect")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    # rows that repeat id and text are one member with a number of rows
    members = rows.where("_suspect").groupBy("text_sha256", "doc_id").agg(F.count(F.lit(1)).alias("_rows"))
    # stored, so that members of a hot group reach the join by a shuffle that can be split
    groups = stored(rows.where("_suspect").groupBy("text_sha256").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "exact-groups")
    grouped = (members.join(groups, "text_sha256")
               .withColumn("_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
               .select("doc_id", "keep_id", "group_size",
                       (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_nth") == 1)).alias("kept"),
                       "text_sha256"))
    return alone.unionByName(grouped)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they
    were. Of rows that repeat id and text, one stays (any, where their other
    columns differ).

    What goes is a stored list of ids and digests. Rows whose ids fall into none of
    its buckets stay where they are; the others meet it by id and digest."""
    own = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    rows = stored(copy_groups(docs, id_col, text_col, digest_all=True)
                  .groupBy(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("__id"), F.col("text_sha256").alias("__text"))
                  .agg(F.max("kept").alias("some"), F.min("kept").alias("all"), F.count(F.lit(1)).alias("n"))
                  .where("NOT all"), "copies")
    others, suspects = split_by_ids(docs, own, rows, "__id")
    text = F.sha2(F.encode(normalised(F.col(text_col)), "UTF-8"), 256)
    keyed = suspects.withColumn("__id", own).withColumn("__text", text)
    keys = ["__id", "__text"]
    left = keyed.join(rows.select(*keys), keys, "left_anti")
    repeated = rows.where("some").select(*keys)  # a row that stays and others like it
    if not repeated.isEmpty():
        left = left.unionByName(keyed.join(repeated, keys, "left_semi").dropDuplicates(keys))
    return others.unionByName(left.drop(*keys))
