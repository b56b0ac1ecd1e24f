"""Named queries over the test tables, one per operator.

The tables an operator reads are built from the given files once per session and stored in the
shared folder, as the layers of a warehouse are; the query itself is then computed from them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import dimensions, quality
from ..operators.items_mart import items_month_rank, items_week_rank
from ..operators.orders_mart import order_driver_stats, order_item_metrics
from ..operators.staging import reject_counts, stage
from ..session import freed_shuffles, shuffle_partitions, tune, work_folder
from ..sources import samples
from ..sources.files import Warehouse, line_writer, read_order_lines
from .refresh import BUILD, STAGED, audit


class Layers:
    """Warehouse tables of one test folder, each built when first asked for."""

    def __init__(self, spark: SparkSession, folder: str, dirty: bool = False):
        self.spark, self.folder, self.dirty = spark, folder, dirty
        given = hashlib.sha1(folder.encode()).hexdigest()[:12]
        variant = "dirty" if dirty else "clean"
        self.store = Warehouse(spark, f"{work_folder(spark)}/{given}-{variant}", 1)
        self.built: set[str] = set()

    def raw_path(self) -> str:
        path = f"{self.store.root}/raw"
        if "raw" not in self.built:
            lines = samples.order_lines(self.spark, self.folder)
            if self.dirty:
                lines = samples.dirty_order_lines(lines)
            with freed_shuffles(self.spark):
                line_writer(lines).parquet(path)
            self.built.add("raw")
        return path

    def rows(self, table: str) -> DataFrame:
        """The table's operator over its stored inputs."""
        if table == STAGED:
            return stage(read_order_lines(self.spark, self.raw_path()))
        if table == "dim_user":
            return dimensions.dim_user(
                samples.existing_users(self.spark, self.folder), self[STAGED]
            )
        if table == "dim_driver":
            return dimensions.dim_driver(
                samples.existing_drivers(self.spark, self.folder), self[STAGED]
            )
        return BUILD[table](self)

    def __getitem__(self, table: str) -> DataFrame:
        if table not in self.built:
            with freed_shuffles(self.spark):
                self.store.write(table, self.rows(table))
            self.built.add(table)
        return self.store[table]


_layers: dict[tuple, Layers] = {}


def layers(spark: SparkSession, folder: str, dirty: bool = False) -> Layers:
    key = (spark.sparkContext.applicationId, str(folder).rstrip("/"), dirty)
    if key not in _layers:
        tune(spark, shuffle_partitions(spark.read.parquet(f"{key[1]}/lineitem.parquet")))
        _layers[key] = Layers(spark, key[1], dirty)
    return _layers[key]


def _clean(query: Callable[[Layers], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(layers(spark, folder))


def _dirty(query: Callable[[Layers], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: query(layers(spark, folder, dirty=True))


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return _clean(lambda t: t.rows(name))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stage_delivery_raw": _table(STAGED),
    "dim_user_upsert": _table("dim_user"),
    "dim_driver_upsert": _table("dim_driver"),
    **{name: _table(name) for name in BUILD if name != "placed_order"},
    "fact_row_counts": _clean(audit),
    "order_item_metrics": _clean(lambda t: order_item_metrics(t["fact_order_item"])),
    "order_driver_stats": _clean(
        lambda t: order_driver_stats(t["fact_order_driver_assignment"])
    ),
    "items_week_rank": _clean(lambda t: items_week_rank(t["items_daily_base"])),
    "items_month_rank": _clean(lambda t: items_month_rank(t["items_daily_base"])),
    "dq_pk_duplicates": _dirty(quality.pk_duplicates),
    "dq_fk_orphans": _dirty(quality.fk_orphans),
    "dq_not_null": _dirty(quality.null_violations),
    "dq_staging_rejects": _clean(
        lambda t: reject_counts(
            samples.mistyped_order_lines(read_order_lines(t.spark, t.raw_path()))
        )
    ),
    "dq_upsert_conflicts": _dirty(lambda t: quality.upsert_conflicts(t[STAGED])),
}
