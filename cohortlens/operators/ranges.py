"""Ranges of the sort order for keys with very many rows.

A key (an account, an owner) may hold a third of all rows. Where its rows must be
taken in order, it is cut into ranges: bounds come from a sample of the sort keys,
and a row's range is an expression over its own sort key, so that rows move once.
Keys with few rows have one range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import listagg
from ..sources.scratch import stored

#: Columns that hold a row's sort key (a struct) and the number of its range.
ORDER, RANGE = "_order", "_range"
#: Rows of a key beyond which it is cut, ranges it is cut into at most, and sort
#: keys sampled for each bound (some 16,000 of a key at most).
RANGE_ROWS, MOST_RANGES, SAMPLED = 1_000_000, 512, 32


def range_bounds(narrow: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame | None:
    """``_key, _bounds`` for the keys of ``narrow(_of, _order)`` with more than
    ``range_rows`` rows: ascending sort keys that cut them into ranges of about as
    many, or into MOST_RANGES; None without such keys. Bounds only deal out rows:
    any would give the same result. ``narrow`` is read twice and should be stored."""
    sizes = narrow.groupBy("_of").agg(F.count(F.lit(1)).alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= range_rows:
        return None
    hot = stored(sizes.where(F.col("_n") > range_rows), "hot-keys").select(
        F.struct("_of").alias("_key"), "_n", F.least(F.ceil(F.col("_n") / range_rows), F.lit(MOST_RANGES)).alias("_ranges"))
    share = F.least(F.lit(1.0), F.col("_ranges") * SAMPLED / F.col("_n"))
    drawn = F.pmod(F.xxhash64(ORDER), F.lit(1 << 30)) < share * (1 << 30)
    sample = narrow.withColumn("_key", F.struct("_of")).join(hot, "_key").where(drawn)
    # a key's sample is bounded; sort keys that many rows share are drawn together, once
    keys = sample.select("_key", "_ranges", ORDER).distinct().groupBy("_key").agg(
        F.first("_ranges").alias("_ranges"), F.sort_array(F.collect_list(ORDER)).alias("_keys"))
    step = F.greatest(F.lit(1), F.floor(F.size("_keys") / F.col("_ranges")))
    return stored(keys.select("_key", F.filter("_keys", lambda _, i: (i > 0) & (i % step == 0)).alias("_bounds")), "range-bounds")


def with_range(rows: DataFrame, of: str, bounds: DataFrame | None) -> DataFrame:
    """The rows, which have their sort key in ORDER, with the number of its range."""
    if bounds is None:
        return rows.withColumn(RANGE, F.lit(0))
    # one struct as key: a NULL is a key too
    joined = rows.withColumn("_key", F.struct(F.col(of).alias("_of"))).join(bounds, "_key", "left")
    part = F.coalesce(F.size(F.filter("_bounds", lambda b: b <= F.col(ORDER))), F.lit(0))
    return joined.withColumn(RANGE, F.when(F.col("_bounds").isNull(), 0).otherwise(part)).drop("_key", "_bounds")


def ordered_strings(rows: DataFrame, of: str, order: list[str], values: list[str], sep: str = ", ",
                    range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row per ``of``: the strings of each column of ``values``, joined in the
    order given (NULLs left out; NULL where all are).

    The strings of a key's ranges are made apart and joined in the order of the
    ranges: no task takes the rows of a whole key, only its ranges' strings."""
    kept = stored(rows.select(of, F.struct(*order).alias(ORDER), *values), "strings")
    bounds = range_bounds(kept.select(F.col(of).alias("_of"), ORDER), range_rows)
    ranged = with_range(kept, of, bounds)
    parts = ranged.groupBy(of, RANGE).agg(*[listagg(v, ORDER, sep).alias(v) for v in values])
    if bounds is None:
        return parts.drop(RANGE)
    return parts.groupBy(of).agg(*[listagg(v, RANGE, sep).alias(v) for v in values])
