"""Shared helpers: table access, stored intermediates, Arrow batches as bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources import hadoop

#: Arrow batches stay small in rows and bytes, so that a worker's memory does
#: not depend on how long the texts are (one text is the unit that remains).
JOB_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
    # shuffle files go when the job that wrote them has ended
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
#: Bytes of text that the numpy kernels work on at once.
SLICE_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    return spark


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder below the shared checkpoint folder, which every executor sees."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{tag}-{uuid.uuid4().hex}"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut,
    lost executors cost nothing that was computed before, and several readers
    share one computation."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Remove what :func:`stored` wrote, once all that is made of it is stored too."""
    for t in tables:
        hadoop.remove(t.sparkSession, t.stored_at)


#: Buckets of a list of ids, and so the most rows of what is broadcast of it.
ID_BUCKETS = 1 << 20


def split_by_ids(rows: DataFrame, own: Column, ids: DataFrame, listed: str) -> tuple[DataFrame, DataFrame]:
    """The rows that surely have none of the ids in column ``listed``, and the others.

    Ids fall into a fixed number of buckets, and the list of the buckets hit is
    broadcast, which has a proven size: rows of other buckets never move."""
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(ID_BUCKETS))
    hit = F.broadcast(ids.select(bucket(F.col(listed)).alias("__bucket")).distinct())
    marked = rows.withColumn("__bucket", bucket(own))
    return marked.join(hit, "__bucket", "left_anti").drop("__bucket"), marked.join(hit, "__bucket", "left_semi").drop("__bucket")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if column.null_count:
        lengths = np.diff(at)
        valid = np.asarray(column.is_valid())
        if lengths[~valid].any():  # a null slot may still point at bytes
            return utf8(column.fill_null("" if not pa.types.is_binary(column.type) else b""))
    return raw[at[0]:at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (or one row), in order."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last
