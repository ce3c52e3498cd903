"""Days between an account's consecutive deals.

A positive interval only arises between consecutive *distinct* deal dates
(a deal on the same day as the previous one gives 0 and is dropped), so the
intervals are taken over distinct (account, date) rows: the ``lag`` window
then holds at most one row per calendar day of an account, however many deals
a hot account has. Medians are exact: Spark's ``median`` keeps one counter per
distinct value, and day counts are bounded by the calendar span.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def return_intervals(base: DataFrame, keys: Sequence[str] = ("accountid",),
                     date: str = "activity_date") -> DataFrame:
    """One row per positive return interval (in days)."""
    keys = list(keys)
    days = base.where(F.col(date).isNotNull()).select(*keys, F.col(date).alias("d")).distinct()
    w = Window.partitionBy(*keys).orderBy("d")
    prev = days.withColumn("prev", F.lag("d").over(w)).where(F.col("prev").isNotNull())
    return prev.select(*keys, F.datediff("d", "prev").cast("bigint").alias("return_interval"))


def return_interval_stats(base: DataFrame) -> DataFrame:
    """D20 (G20): mean and median over all accounts."""
    iv = return_intervals(base)
    return iv.agg(F.count(F.lit(1)).alias("intervals"),
                  F.avg("return_interval").alias("mean_days"),
                  F.median("return_interval").cast("double").alias("median_days"))


def return_interval_stats_by(base: DataFrame, by: str = "product_label_category") -> DataFrame:
    """D21 (G21): mean, median and count per category, intervals taken within
    (account, category)."""
    iv = return_intervals(base, ("accountid", by))
    return iv.groupBy(by).agg(F.avg("return_interval").alias("mean_days"),
                              F.median("return_interval").cast("double").alias("median_days"),
                              F.count(F.lit(1)).alias("intervals"))


def return_interval_histogram(base: DataFrame, bins: int = 30) -> DataFrame:
    """D22 (G22): equal-width histogram over [min, max], the maximum falling
    into the last bin; every bin is reported, empty ones with 0."""
    iv = return_intervals(base)
    b = F.broadcast(iv.agg(F.min("return_interval").alias("lo"), F.max("return_interval").alias("hi")))
    width = (F.col("hi") - F.col("lo")).cast("double")
    pos = F.when(width == 0, F.lit(1)).otherwise(
        F.floor(F.lit(float(bins)) * (F.col("return_interval") - F.col("lo")).cast("double") / width) + 1)
    counted = (iv.crossJoin(b).select(F.least(pos, F.lit(bins)).cast("bigint").alias("bin"))
               .groupBy("bin").agg(F.count(F.lit(1)).alias("frequency")))
    # bins x (lo, hi): a fixed number of rows
    grid = b.crossJoin(F.broadcast(iv.sparkSession.range(1, bins + 1).withColumnRenamed("id", "bin")))
    edges = grid.select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1).cast("double") * (F.col("hi") - F.col("lo")).cast("double")
         / F.lit(float(bins))).alias("lower"),
        (F.col("lo") + F.col("bin").cast("double") * (F.col("hi") - F.col("lo")).cast("double")
         / F.lit(float(bins))).alias("upper"))
    return edges.join(counted, "bin", "left").select(
        "bin", "lower", "upper", F.coalesce("frequency", F.lit(0)).cast("bigint").alias("frequency"))
