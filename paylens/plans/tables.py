"""The published tables as the reports see them."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from threading import RLock
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.labels import delivered, high_value, spending_bin
from paylens.functions.time import has_time, hour, iso_weekday
from paylens.operators.folders import Files
from paylens.operators.jobs import together
from paylens.operators.publish import write_parquet
from paylens.session import work_dir
from paylens.sources import catalog

SHARED = ("segment_orders", "person_segments", "order_times", "spending_bins")

Read = Callable[[str], DataFrame]
Store = Callable[[str, DataFrame], DataFrame]


def shared_store(spark: SparkSession, folder: str) -> Store:
    """Writes frames shared by reports into ``folder``."""

    def store(name: str, df: DataFrame) -> DataFrame:
        path = f"{folder}/{name}"
        write_parquet(df, path)
        return spark.read.parquet(path)

    return store


class ReportTables:
    """Published tables by name, and frames that many reports share.

    ``read`` returns a published table. ``store``, if given, writes a shared frame once
    and returns a scan of it: the reports of a batch then scan the result of the large
    join instead of repeating it, and joins to the person table have plain scans on both
    sides, which lets adaptive execution split a person with very many orders.
    """

    def __init__(self, read: Read, store: Store | None = None):
        self._read = read
        self._store = store
        self._locks = {name: RLock() for name in SHARED}
        self._shared: dict[str, DataFrame] = {}

    @classmethod
    def from_catalog(
        cls, spark: SparkSession, database: str = catalog.DATABASE, store: Store | None = None
    ) -> ReportTables:
        """Tables of a database, and the shared frames written with them at the last load.

        Where there are none, or a table was published by itself since, shared frames go to a
        folder of this object's own. Make a new object after the tables were published again.
        """
        folder = f"{work_dir(spark)}/{database}-{uuid4().hex}"
        tables = cls(
            lambda name: catalog.published(spark, name, database),
            store or shared_store(spark, folder),
        )
        stored = None if store else catalog.shared_folder(spark, database)
        if stored:
            there = set(Files(spark).names(stored))  # a load of an earlier release has fewer
            tables._shared = {
                name: spark.read.parquet(f"{stored}/{name}") for name in SHARED if name in there
            }
        return tables

    @property
    def fact(self) -> DataFrame:
        return self._read("fact_payments")

    @property
    def delivered(self) -> DataFrame:
        return self.fact.where(delivered())

    @property
    def segments(self) -> DataFrame:
        return self._read("customer_segments")

    @property
    def states(self) -> DataFrame:
        return self._read("revenue_by_state")

    @property
    def leakage(self) -> DataFrame:
        return self._read("revenue_leakage")

    @property
    def items(self) -> DataFrame:
        return self._read("order_items_products")

    def _share(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        with self._locks[name]:
            if name not in self._shared:
                df = build()
                self._shared[name] = self._store(name, df) if self._store else df
            return self._shared[name]

    @property
    def segment_orders(self) -> DataFrame:
        """Delivered orders joined to the segment row of their customer id."""

        def build() -> DataFrame:
            order = self.delivered.select(
                "customer_id",
                "order_purchase_timestamp",
                "total_payment",
                "max_installments",
                "payment_type",
            )
            row = self.segments.select("customer_id", "customer_state", "total_spent", "segment")
            return order.join(row, "customer_id")

        return self._share("segment_orders", build)

    @property
    def person_segments(self) -> DataFrame:
        """Number of segment rows per person and segment.

        Joins on the person use this count as a weight: joining the segment rows
        themselves would emit every pair of order and segment row of a person.
        """

        def build() -> DataFrame:
            return self.segments.groupBy("customer_unique_id", "segment").agg(
                F.count(F.lit(1)).alias("weight")
            )

        return self._share("person_segments", build)

    @property
    def order_times(self) -> DataFrame:
        """Delivered orders, and those of high-value customer ids, by weekday and hour.

        At most 168 rows. The parts of the time are taken before the semi join, so that only they
        and the customer id are moved, once for all reports on times.
        """

        def build() -> DataFrame:
            timed = self.delivered.where(has_time()).select(
                "customer_id", iso_weekday().alias("day_of_week"), hour().alias("hour_of_day")
            )
            hv_ids = self.segments.where(high_value()).select("customer_id")
            parts = ["day_of_week", "hour_of_day"]
            tagged = timed.select(*parts, F.lit(False).alias("hv")).unionByName(
                timed.join(hv_ids, "customer_id", "left_semi").select(
                    *parts, F.lit(True).alias("hv")
                )
            )
            return tagged.groupBy(*parts).agg(
                F.count_if(~F.col("hv")).alias("all_orders"), F.count_if("hv").alias("hv_orders")
            )

        return self._share("order_times", build)


    @property
    def spending_bins(self) -> DataFrame:
        """Customers per spending bin, dealt into slices of neighbouring bins.

        A slice is what one task of a range partitioning holds, numbered in order, so that running totals
        need not pass all bins through one task.
        """

        def build() -> DataFrame:
            counted = self.segments.groupBy(spending_bin().alias("spending_bin")).agg(
                F.count(F.lit(1)).alias("customer_count")
            )
            return counted.repartitionByRange("spending_bin").withColumn(
                "slice", F.spark_partition_id()
            )

        return self._share("spending_bins", build)


def refresh_shared(spark: SparkSession, database: str = catalog.DATABASE) -> str | None:
    """Write the shared frames of the published tables into a new folder beside them.

    Reports find it through a property of the fact table, which a later publication of a table
    takes back; the folder that this one replaces is deleted. None without the tables needed.
    """
    if not {"fact_payments", "customer_segments"} <= set(catalog.list_published(spark, database)):
        return None
    old = catalog.shared_folder(spark, database, current=False)
    folder = f"{catalog.location(spark, database)}/shared_{uuid4().hex}"
    tables = ReportTables(
        lambda name: catalog.published(spark, name, database), shared_store(spark, folder)
    )
    together(spark, {name: partial(getattr, tables, name) for name in SHARED})
    catalog.set_shared_folder(spark, database, folder)
    if old and old != folder:
        catalog.delete_folder(spark, old)
    return folder
