"""Files in the store that Spark reads and writes, through its Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(conf), where, jvm, conf


def exists(spark: SparkSession, path: str) -> bool:
    store, where, *_ = _at(spark, path)
    return store.exists(where)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if it isn't there."""
    store, where, *_ = _at(spark, folder)
    return sorted(s.getPath().getName() for s in store.listStatus(where)) if store.exists(where) else []


def size(spark: SparkSession, path: str) -> int:
    store, where, *_ = _at(spark, path)
    return store.getContentSummary(where).getLength() if store.exists(where) else 0


def remove(spark: SparkSession, path: str) -> None:
    store, where, *_ = _at(spark, path)
    store.delete(where, True)


def joined(spark: SparkSession, folder: str, path: str, head: bytes = b"") -> None:
    """One file of ``head`` and a folder's part files in the order of their names.
    Bytes are streamed; the file has its name only once it is whole."""
    store, where, jvm, conf = _at(spark, path)
    unfinished = jvm.org.apache.hadoop.fs.Path(f"{path}.unfinished")
    out = store.create(unfinished, True)
    try:
        out.write(bytearray(head))
        for name in children(spark, folder):
            if name.startswith("part-"):
                part = store.open(jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}"))
                try:
                    jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
                finally:
                    part.close()
    finally:
        out.close()
    store.delete(where, False)
    if not store.rename(unfinished, where):
        raise OSError(f"{path} couldn't be named")
