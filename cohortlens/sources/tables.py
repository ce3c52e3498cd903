"""Lazy table scans.

``spark.read.parquet`` only records the scan; Catalyst prunes the columns a
plan does not use and pushes simple filters into the Parquet reader, so every
adapter can start from the full table without reading it in full.
"""

from __future__ import annotations

from functools import cached_property

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import contracts
from .scratch import stored

TABLE_NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


class Tables:
    """Named access to the input tables: Parquet below one folder (``root``), or
    whatever ``bound`` names instead, by table name: a table, a (temporary) view, or
    a DataFrame. Every table has the columns and kinds of :mod:`.contracts`; all
    that are missing or of another kind are reported together, when it is first read.

    ``share`` keeps derived tables that several parts of a plan read (``(name, build)
    -> DataFrame``, as layers do); without it they are stored for this object."""

    def __init__(self, spark: SparkSession, root: str | None = None, bound: dict[str, str | DataFrame] | None = None,
                 share: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None):
        self.spark = spark
        self.root = root.rstrip("/") if root else None
        self.bound = dict(bound or {})
        self._share = share
        self._shared: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        source = self.bound.get(name)
        if isinstance(source, DataFrame):
            df = source
        elif source is not None:
            df = self.spark.table(source)
        elif self.root:
            df = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        else:
            raise ValueError(f"table {name} isn't bound, and there is no folder to read it from")
        return contracts.checked(name, df)

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A derived table that several parts of a plan read: computed once for
        this object and stored, or kept by ``share``."""
        if name not in self._shared:
            self._shared[name] = self._share(name, build) if self._share else stored(build(), name)
        return self._shared[name]

    @cached_property
    def customer(self) -> DataFrame:
        return self.read("customer")

    @cached_property
    def nation(self) -> DataFrame:
        return self.read("nation")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.read("supplier")

    @cached_property
    def part(self) -> DataFrame:
        return self.read("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.read("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")
