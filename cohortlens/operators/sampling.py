"""All rows of a few sampled accounts.

The notebook draws 3 accounts at random (with replacement, unseeded). Here draws are
deterministic. Without replacement, accounts are ranked by a seeded multiplicative
hash (the same integer arithmetic in any engine) and the first ``k`` are kept; a
top-k, not a sort of all accounts. With replacement, the hash puts the accounts on a
circle; each draw is a point on it, and takes the account that follows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODULUS = 2147483647   # 2^31 - 1
MULTIPLIER = 48271


def sample_key(account, seed: int):
    return ((account % MODULUS) * MULTIPLIER + seed) % MODULUS


def sample_accounts(base: DataFrame, category: str = "TRADING ONLY", k: int = 3, seed: int = 7,
                    key: str = "accountid", category_col: str = "first_product_category") -> DataFrame:
    """Every base row of ``k`` sampled accounts of a category."""
    ids = base.where(F.col(category_col) == category).select(key).distinct()
    picked = (ids.withColumn("_h", sample_key(F.col(key), seed))
              .orderBy("_h", key).limit(k).select(key))
    # at most k rows
    return base.join(F.broadcast(picked), key, "left_semi")


#: What a draw's point moves on by.
STRIDE = 1_103_515_245


def drawn_accounts(base: DataFrame, category: str = "TRADING ONLY", k: int = 3, seed: int = 7,
                   key: str = "accountid", category_col: str = "first_product_category") -> DataFrame:
    """``key, draws``: how often each account was taken by ``k`` draws with
    replacement. Every draw is a minimum over all accounts; all are one aggregation."""
    ids = base.where(F.col(category_col) == category).select(key).distinct()
    place = sample_key(F.col(key), seed)
    way = lambda i: (place + F.lit((i + 1) * STRIDE % MODULUS)) % MODULUS
    picks = ids.agg(F.array(*[F.min(F.struct(way(i).alias("way"), F.col(key))) for i in range(k)]).alias("picks"))
    return (picks.select(F.explode("picks").alias("pick")).where(F.col("pick").isNotNull())
            .groupBy(F.col(f"pick.{key}").alias(key)).agg(F.count(F.lit(1)).alias("draws")))


def sample_accounts_with_replacement(base: DataFrame, category: str = "TRADING ONLY", k: int = 3, seed: int = 7,
                                     key: str = "accountid", category_col: str = "first_product_category") -> DataFrame:
    """Every base row of the drawn accounts, with its account's ``draws``."""
    # at most k rows
    return base.join(F.broadcast(drawn_accounts(base, category, k, seed, key, category_col)), key)
