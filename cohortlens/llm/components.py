"""Connected components by alternating star contractions, as DataFrame jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, stored


def _contract(links: DataFrame, larger_only: bool) -> DataFrame:
    """Point neighbours of each node at the smallest of them and the node.

    Large star: every larger neighbour. Small star: the node itself and its
    smaller neighbours. Minima combine map-side."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    if not larger_only:
        both = both.where("v < u")
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    near = (both.where("v > u") if larger_only else both).join(low, "u")
    out = near.select(F.col("m").alias("a"), F.col("v").alias("b"))
    if not larger_only:
        out = out.unionByName(low.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return out.where("a <> b").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) for every node of ``links(a, b)``.

    Rounds are stored, so a round never depends on the ones before it; they end
    when the links no longer change, which is after a few even for long chains."""
    links = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "links")
    state = _state(links)
    while state[0]:
        former, links = links, stored(_contract(_contract(links, larger_only=True), larger_only=False), "links")
        dropped(former)
        state, before = _state(links), state
        if state == before:
            break
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
