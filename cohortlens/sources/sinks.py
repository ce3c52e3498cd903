"""Writing results.

Writes are distributed (one file per partition); nothing is gathered into one
task. A single ordered file is made of part files written in order, whose bytes
are joined in the store.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hadoop
from .scratch import stored


def create_or_replace_table(df: DataFrame, name: str) -> None:
    """Create-or-replace-table-as-select into the session catalog."""
    df.write.mode("overwrite").saveAsTable(name)


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV with a header row (Spark has no index column to add or drop)."""
    df.write.mode("overwrite").option("header", header).csv(path)


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows dealt out by ranges of the order and sorted within them (NULLs first)."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_sorted(df: DataFrame, path: str, order: Sequence[str], fmt: str = "parquet") -> None:
    """O3: files whose names ascend with the order of the rows in them."""
    in_order(df, order).write.mode("overwrite").format(fmt).save(path)


def numbered(df: DataFrame, order: Sequence[str], name: str = "index") -> DataFrame:
    """The rows with their number (from 0) in the order, which should be total: the
    rows of the ranges before it (one count per range) and the place within it."""
    # the id of a row is its range's number and its place there
    rows = stored(in_order(df, order).withColumn("_id", F.monotonically_increasing_id()), "numbered")
    of = F.shiftright("_id", 33)
    counts = rows.groupBy(of.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = F.broadcast(counts.select("_part", F.coalesce(before, F.lit(0)).alias("_start")))  # a row per range
    place = F.col("_id").bitwiseAND((1 << 33) - 1)
    return (rows.withColumn("_part", of).join(starts, "_part")
            .select((F.col("_start") + place).alias(name), *df.columns))


def export_csv(df: DataFrame, path: str, order: Sequence[str], index: str | None = None) -> None:
    """One CSV file with a header, its rows in order, and with ``index`` a
    first column of that name that numbers them from 0."""
    rows = numbered(df, order, index or "_index")
    keyed = rows.repartitionByRange(index or "_index").sortWithinPartitions(index or "_index")
    parts = f"{path}.parts"
    out = keyed if index else keyed.drop("_index")
    out.write.mode("overwrite").option("header", False).csv(parts)
    quoted = ",".join(c if c.replace("_", "").isalnum() else '"' + c.replace('"', '""') + '"' for c in out.columns)
    hadoop.joined(df.sparkSession, parts, path, (quoted + "\n").encode())
    hadoop.remove(df.sparkSession, parts)


def export_by_dim(df: DataFrame, period: str, by: Sequence[str] | str, value: str, value_name: str,
                  path: str | None = None) -> DataFrame:
    """Sum one measure by period and dimension(s), truncated to a whole
    number, optionally written as CSV; returns the long result."""
    by = [by] if isinstance(by, str) else list(by)
    out = df.groupBy(period, *by).agg(F.sum(value).cast("bigint").alias(value_name))
    if path:
        write_csv(out, path)
    return out
