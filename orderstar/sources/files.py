"""Parquet input and the warehouse folder."""

from __future__ import annotations

import re
import threading
import time
from collections.abc import Iterable
from functools import cached_property

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from ..schemas import DIMENSIONS, FACTS, MARTS, TABLES, conform, ddl
from ..session import few_rows, folder_names, freed_shuffles, remove_folder

LAYERS = {
    "delivery_raw": "staging",
    **dict.fromkeys([*DIMENSIONS, *FACTS], "core"),
    "placed_order": "work",
    "items_daily_base": "work",
    **dict.fromkeys(MARTS, "mart"),
}

# What the lines of an order share. Lines lie by order, so that zstd stores each of these values once, if no
# dictionary hides the repeats from it.
_SHARED = [
    *("order_id", "user_id", "user_phone", "driver_id", "driver_phone", "address_text"),
    *("created_at", "paid_at", "delivery_started_at", "delivered_at", "canceled_at"),
]
_LINES = ("delivery_raw", "fact_order_item")

_LOG = "version bigint, complete boolean"
_ENTRY = "table string, rows bigint, source string, at bigint"

# Appends to one folder at the same time would delete each other's temporary files.
_appending = threading.Lock()


def read_order_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw order lines from a parquet folder, file or glob; fails if there is none.

    The schema is the files' own, so that unknown columns are seen instead of dropped.
    """
    return spark.read.parquet(path)


def line_writer(rows: DataFrame) -> DataFrameWriter:
    """A writer for order lines."""
    writer = rows.write.mode("overwrite")
    for name in set(_SHARED).intersection(rows.columns):
        writer = writer.option(f"parquet.enable.dictionary#{name}", "false")
    return writer


def _read_log(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


class Warehouse:
    """Parquet tables of one version: ``<root>/v<version>/<layer>/<table>``.

    A refresh fills a version of its own, so tables of different batches never mix. Which versions
    were begun and which are complete is kept in ``<root>/log``, a table that is only appended to;
    readers take the last complete version, and a version without its entry does not exist for them.
    ``<root>/v<version>/log`` has an entry for every table of the version that was written whole, with
    its number of rows. One refresh per root runs at a time.
    """

    def __init__(self, spark: SparkSession, root: str, version: int):
        self.spark = spark
        self.root = root.rstrip("/")
        self.version = version

    @classmethod
    def _versions(cls, spark: SparkSession, root: str) -> tuple[int, int]:
        """The last version begun and the last complete one, 0 where there is none."""
        log = _read_log(spark, f"{root.rstrip('/')}/log", _LOG)
        if log is None:
            return 0, 0
        done = F.max(F.when(F.col("complete"), F.col("version")))
        begun, complete = log.agg(F.max("version"), done).first()
        return begun or 0, complete or 0

    @classmethod
    def current(cls, spark: SparkSession, root: str) -> Warehouse | None:
        """The last complete version."""
        version = cls._versions(spark, root)[1]
        return cls(spark, root, version) if version else None

    @classmethod
    def begin(cls, spark: SparkSession, root: str) -> Warehouse:
        """A new, empty version."""
        new = cls(spark, root, cls._versions(spark, root)[0] + 1)
        new._note(False)
        return new

    @classmethod
    def unfinished(cls, spark: SparkSession, root: str) -> Warehouse | None:
        """The version begun last, if it is not complete yet."""
        begun, complete = cls._versions(spark, root)
        return cls(spark, root, begun) if begun > complete else None

    @classmethod
    def begun(cls, spark: SparkSession, root: str) -> Warehouse:
        """The version begun last, which must not be complete yet."""
        target = cls.unfinished(spark, root)
        if target is None:
            raise ValueError(f"no version of {root} is being built: load order lines first")
        return target

    def finish(self) -> None:
        """Make this the version readers see; every declared table has to be entered."""
        missing = [table for table in TABLES if table not in self.entries]
        if missing:
            raise ValueError(f"version {self.version} of {self.root} lacks {', '.join(missing)}")
        self._note(True)

    def _note(self, complete: bool) -> None:
        self._append(f"{self.root}/log", version=self.version, complete=complete)

    def _append(self, path: str, **values) -> None:
        entry = self.spark.range(1, numPartitions=1)
        with _appending:
            entry.select(*(F.lit(v).alias(k) for k, v in values.items())).write.mode(
                "append"
            ).parquet(path)

    @property
    def folder(self) -> str:
        return f"{self.root}/v{self.version:06d}"

    @cached_property
    def entries(self) -> dict[str, tuple[int, str]]:
        """Tables that were written whole: how many rows, and what they were read from if that was
        named. Other processes' entries are seen as of the first look.
        """
        log = _read_log(self.spark, f"{self.folder}/log", _ENTRY)
        if log is None:
            return {}
        # A few rows a table; the last one counts.
        last = log.groupBy("table").agg(F.max(F.struct("at", "rows", "source")).alias("last"))
        found = {row["table"]: row["last"] for row in last.collect()}
        return {t: (e["rows"], e["source"]) for t, e in found.items() if e["rows"] is not None}

    def _enter(self, table: str, rows: int | None, source: str | None = None) -> None:
        """Note that a table is whole, or, without a number of rows, that it no longer is."""
        self._append(
            f"{self.folder}/log",
            table=table,
            rows=F.lit(rows).cast("bigint"),
            source=F.lit(source).cast("string"),
            at=time.time_ns(),
        )
        if rows is None:
            self.entries.pop(table, None)
        else:
            self.entries[table] = (rows, source)

    def row_counts(self, tables: Iterable[str]) -> DataFrame:
        """(table_name, row_cnt) as counted while the tables were written; nothing is read again."""
        counted = [{"table_name": t, "row_cnt": self.entries[t][0]} for t in tables]
        return few_rows(self.spark, counted, "table_name: string, row_cnt: bigint")

    def path(self, table: str) -> str:
        return f"{self.folder}/{LAYERS[table]}/{table}"

    def __getitem__(self, table: str) -> DataFrame:
        stored = self.spark.read.schema(ddl(table)).parquet(self.path(table))
        return stored.select(*TABLES[table])

    def write(self, table: str, rows: DataFrame, source: str | None = None) -> None:
        """Replace a table and enter it. Marts are laid out by report date, in balanced files per date.

        The rows are counted by the tasks that write them. While a table that was entered before is
        replaced it counts as missing.
        """
        if table in self.entries:
            self._enter(table, None)
        rows = conform(rows, table)
        if table in MARTS:
            # AQE splits a large date over several files and joins small ones.
            rows = rows.hint("rebalance", "report_date")
        written = Observation()
        # Last in the plan: tasks of the stage that writes count once, however often others are repeated.
        rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
        writer = line_writer(rows) if table in _LINES else rows.write.mode("overwrite")
        if table in MARTS:
            # A session that overwrites partitions one by one would leave the dates of an earlier write.
            writer = writer.option("partitionOverwriteMode", "static").partitionBy("report_date")
        with freed_shuffles(self.spark):
            writer.parquet(self.path(table))
        self._enter(table, written.get["rows"], source)


def remove_old_versions(spark: SparkSession, root: str, keep: int) -> list[int]:
    """Delete all versions but the last ``keep`` complete ones, the current one and one being built.

    Versions that failed go as soon as a later one was begun. Returns the versions deleted. Whoever
    still reads a deleted version fails, so ``keep`` is how many refreshes a reader may last.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1: the current version stays")
    root = root.rstrip("/")
    log = _read_log(spark, f"{root}/log", _LOG)
    if log is None:
        return []
    complete = log.filter("complete").select("version").distinct().orderBy(F.desc("version"))
    kept = {row["version"] for row in complete.limit(keep).collect()}
    building = Warehouse.unfinished(spark, root)
    if building is not None:
        kept.add(building.version)
    gone = []
    for name in sorted(folder_names(spark, root)):
        if re.match(r"v\d{6,}\Z", name) and int(name[1:]) not in kept:
            remove_folder(spark, f"{root}/{name}")
            gone.append(int(name[1:]))
    return gone
