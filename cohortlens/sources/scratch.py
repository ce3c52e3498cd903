"""Intermediate results in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import checkpoint_dir

#: Spark's setting by which an action removes the files of its shuffles when it ends.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet. Its shuffles are of no use after that: their files go at
    once, so that a chain of stored tables holds one table's shuffles at a time, not all."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP_CONF, None)
    conf.set(CLEANUP_CONF, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.unset(CLEANUP_CONF) if before is None else conf.set(CLEANUP_CONF, before)


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: one computation for
    all its readers, and nothing before it runs again if an executor is lost."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/cohortlens-scratch/{tag}-{uuid.uuid4().hex}"
    write(df, path)
    return spark.read.schema(df.schema).parquet(path)
