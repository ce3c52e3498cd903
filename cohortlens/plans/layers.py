"""Stored layers (fee ledger, deal fact, ...), rebuilt when asked for.

The reference persists each layer as a table and reads it back for the KPI
queries, with a switch to rebuild. Here a layer is written as Parquet below the
shared folder named by ``spark.checkpoint.dir``: later products scan it with
column pruning and pushdown, and the write cuts the lineage.

A layer belongs to a *state* of its inputs: its key holds the input folder, the
names, sizes and modification times of the input files, and the state of this
package's code. When a file or the code changes, the key changes, and the old layer
is never read for it.

Layers are built from layers. A build is registered with the versions of those it
was built from, and counts only as long as these are the current ones: building the
ledger anew makes the deal fact and what comes of it be built anew, and nothing else.

Every build writes a folder of its own. Only when that write has been committed
does the layers' register (a small Parquet table that is appended to, and read once)
name it; readers take the last entry. A build that fails leaves the register, and so the
layer before it, as they were. Versions that later ones have replaced are removed,
but for the last, which a reader may still hold."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable, Collection
from functools import lru_cache
from importlib import resources

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import __version__
from ..session import checkpoint_dir
from ..sources import hadoop, scratch

REBUILD_CONF = "spark.cohortlens.rebuild"
_REGISTER = "layer string, version string, built_at long, inputs map<string,string>"


def inputs_state(spark: SparkSession, root: str, tables: tuple[str, ...]) -> str:
    """Digest of the input files' names, sizes and modification times. The file
    listing is Spark's, so it works on any store; no content is read."""
    paths = [f"{root.rstrip('/')}/{t}.parquet" for t in tables]
    files = spark.read.format("binaryFile").load(paths).select("path", "length", F.col("modificationTime").cast("double").alias("at"))
    one = files.agg(F.count(F.lit(1)), F.sum("length"), F.sum(F.xxhash64("path", "length", "at").cast("decimal(38,0)"))).first()
    return hashlib.sha256(repr((paths, *map(str, one))).encode()).hexdigest()[:24]


@lru_cache(maxsize=1)
def code_state() -> str:
    """Digest of the code that makes the layers, so that changed code never reads
    layers of the code before it."""
    digest = hashlib.sha256(__version__.encode())
    for part in ("functions", "operators", "plans", "sources"):
        for file in sorted((f for f in resources.files(__package__.rpartition(".")[0]).joinpath(part).iterdir() if f.name.endswith(".py")),
                           key=lambda f: f.name):
            digest.update(file.name.encode() + b"\0" + file.read_bytes())
    return digest.hexdigest()


class LayerStore:
    """Layers of one state of one input folder. ``rebuild``: all of them, or those
    named; each once per store."""

    def __init__(self, spark: SparkSession, root: str, tables: tuple[str, ...], rebuild: bool | Collection[str] | None = None):
        self.spark = spark
        key = hashlib.sha256(f"{inputs_state(spark, root, tables)}|{code_state()}".encode()).hexdigest()[:24]
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/cohortlens-layers/{key}"
        self.rebuild = spark.conf.get(REBUILD_CONF, "false") == "true" if rebuild is None else rebuild
        self._known: dict[str, tuple[str, DataFrame]] = {}
        self._register: dict[str, list[tuple[str, dict[str, str]]]] | None = None

    def _registered(self, name: str) -> list[tuple[str, dict[str, str]]]:
        """Versions and what they were built from, the last one first."""
        if self._register is None:
            try:
                rows = self.spark.read.schema(_REGISTER).parquet(f"{self.root}/register").collect()  # a row per build
            except AnalysisException:  # no build has been registered yet
                rows = []
            self._register = {}
            for r in sorted(rows, key=lambda r: (-r["built_at"], r["version"])):
                self._register.setdefault(r["layer"], []).append((r["version"], r["inputs"] or {}))
        return self._register.get(name, [])

    def version(self, name: str) -> str:
        """The version of a layer that this store reads."""
        return self._known[name][0]

    def has(self, name: str, needs: tuple[str, ...] = ()) -> bool:
        """Whether :meth:`get` gives the layer without a build, or is to build it by name."""
        if name in self._known or not isinstance(self.rebuild, bool) and name in self.rebuild:
            return True
        before = self._registered(name)
        return self.rebuild is not True and bool(before) and before[0][1] == {n: self.version(n) for n in needs}

    def get(self, name: str, build: Callable[[], DataFrame], needs: tuple[str, ...] = (), or_needs: tuple[str, ...] | None = None) -> DataFrame:
        """Read the layer; build it first if there is none, if one of the layers it
        ``needs`` (which this store has read) has changed, or on rebuild. A layer that was
        made of ``or_needs`` instead, the same way but for what was stored then, counts as well."""
        if name not in self._known:
            inputs = {n: self.version(n) for n in needs}
            others = inputs if or_needs is None else {n: self.version(n) for n in or_needs}
            wanted = self.rebuild if isinstance(self.rebuild, bool) else name in self.rebuild
            before = self._registered(name)
            if not wanted and before and before[0][1] in (inputs, others):
                version = before[0][0]
            else:
                version = uuid.uuid4().hex
                scratch.write(build(), f"{self.root}/{name}/{version}")
                (self.spark.createDataFrame([(name, version, time.time_ns(), inputs)], _REGISTER).coalesce(1)
                 .write.mode("append").parquet(f"{self.root}/register"))
                for old, _ in before[1:]:
                    hadoop.remove(self.spark, f"{self.root}/{name}/{old}")
            self._known[name] = version, self.spark.read.parquet(f"{self.root}/{name}/{version}")
        return self._known[name][1]
