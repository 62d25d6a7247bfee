"""Marts and published tables of one data set, each written once and read back.

Five marts and all reports depend on the order fact. Writing it cuts the lineage: later
plans start from a scan, and an executor lost after the write costs nothing. Tables may be
asked for from several threads: a lock keeps each one from being written twice.
"""

from __future__ import annotations

from collections.abc import Mapping
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

from paylens.operators.folders import Files, recover
from paylens.operators.manifest import Entry, Manifest, identity
from paylens.operators.publish import publish_path, write_parquet
from paylens.plans.marts import MARTS, SOURCES_OF
from paylens.plans.tables import ReportTables, shared_store
from paylens.schemas import TABLES


class Warehouse:
    def __init__(
        self,
        spark: SparkSession,
        sources: Mapping[str, DataFrame | None],
        root: str,
        manifest: Manifest | None = None,
        landed: Mapping[str, str] | None = None,
    ):
        """``sources`` hold valid payments only; ``root`` is a folder all executors reach.

        With a ``manifest``, marts that were completed from the same sources are not written again;
        ``landed`` then names the present content of each source.
        """
        self.spark = spark
        self._manifest, self._landed = manifest, landed or {}
        self.written: list[str] = []
        self.sources = sources
        self.root = root
        self._locks = {name: RLock() for name in TABLES}
        self.rows: dict[str, int | None] = {}
        self._marts: dict[str, DataFrame | None] = {}
        self._tables: dict[str, DataFrame] = {}

    def plan(self, name: str) -> DataFrame | None:
        """The mart as a frame that is not written yet; None if an optional source is missing."""
        return MARTS[name](self.sources, lambda: self.mart("fact_payments"))

    def _input(self, name: str) -> str:
        """What a mart is made from: the sources as landed, or the order fact as written."""
        if name in SOURCES_OF:
            return identity([[source, self._landed.get(source)] for source in SOURCES_OF[name]])
        self.mart("fact_payments")
        return self._manifest.get("fact_payments").id

    def _write(self, name: str, path: str) -> int | None:
        df = self.plan(name)
        self.written.append(name)
        return None if df is None else write_parquet(df, path)

    def _kept(self, name: str, path: str) -> int | None:
        """The rows of a mart that is written unless it is complete."""
        made_from = self._input(name)
        recover(self.spark, path)
        entry = self._manifest.current(name, made_from)
        if not entry or (entry.rows is not None and not Files(self.spark).exists(path)):
            self._manifest.drop(name)
            entry = self._manifest.put(name, Entry.of(made_from, self._write(name, path)))
        return entry.rows

    def mart(self, name: str) -> DataFrame | None:
        """The written mart."""
        with self._locks[name]:
            if name not in self._marts:
                path = f"{self.root}/transformed/{name}"
                rows = self._kept(name, path) if self._manifest else self._write(name, path)
                self.rows[name] = rows
                self._marts[name] = None if rows is None else self.spark.read.parquet(path)
            return self._marts[name]

    def table(self, name: str) -> DataFrame:
        """The published table, in a folder of its own."""
        with self._locks[name]:
            if name not in self._tables:
                mart = self.mart(name)
                if mart is None:
                    raise ValueError(f"{name} needs a source that is missing")
                path = f"{self.root}/published/{name}"
                publish_path(mart, TABLES[name], path)
                self._tables[name] = self.spark.read.parquet(path)
            return self._tables[name]

    def report_tables(self) -> ReportTables:
        return ReportTables(self.table, shared_store(self.spark, f"{self.root}/shared"))
