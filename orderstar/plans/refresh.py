"""How each table is built from the stored ones, and the full refresh of a warehouse."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..operators import dimensions, facts, quality
from ..operators.items_mart import items_daily_base, items_mart
from ..operators.orders_mart import orders_mart, placed_order
from ..operators.staging import stage
from ..schemas import FACTS
from ..session import freed_shuffles, scratch, shuffle_partitions, tuned
from ..sources.files import Warehouse, read_order_lines

STAGED = "delivery_raw"

# Table -> frame, given the tables already stored.
BUILD = {
    "dim_category": lambda t: dimensions.dim_category(t[STAGED]),
    "dim_payment_type": lambda t: dimensions.dim_payment_type(t[STAGED]),
    "dim_cancellation_reason": lambda t: dimensions.dim_cancellation_reason(t[STAGED]),
    "dim_city": lambda t: dimensions.dim_city(t[STAGED]),
    "dim_address": lambda t: dimensions.dim_address(t[STAGED], t["dim_city"]),
    "dim_store": lambda t: dimensions.dim_store(t[STAGED], t["dim_address"]),
    "dim_item": lambda t: dimensions.dim_item(t[STAGED], t["dim_category"]),
    "fact_order": lambda t: facts.fact_order(
        t[STAGED], t["dim_address"], t["dim_payment_type"], t["dim_cancellation_reason"]
    ),
    "fact_order_item": lambda t: facts.fact_order_item(t[STAGED]),
    "fact_order_driver_assignment": lambda t: facts.fact_order_driver_assignment(t[STAGED]),
    "placed_order": lambda t: placed_order(t["fact_order"], t["dim_address"]),
    "orders_mart": lambda t: orders_mart(
        t["placed_order"],
        t["fact_order_item"],
        t["fact_order_driver_assignment"],
        t["dim_city"],
        t["dim_cancellation_reason"],
    ),
    "items_daily_base": lambda t: items_daily_base(
        t["fact_order_item"],
        t["placed_order"],
        t["dim_item"],
        t["dim_category"],
        t["dim_city"],
    ),
    "items_mart": lambda t: items_mart(t["items_daily_base"]),
}

# Steps run one after the other. The chains of a step do not need each other and are written at the
# same time; a chain writes its tables in order.
CORE_STEPS = [
    [
        ["dim_user"],
        ["dim_driver"],
        ["dim_city", "dim_address", "dim_store"],
        ["dim_category", "dim_item"],
        ["dim_payment_type"],
        ["dim_cancellation_reason"],
        ["fact_order_item"],
        ["fact_order_driver_assignment"],
    ],
    [["fact_order"]],
]
ORDERS_MART = ["orders_mart"]
ITEMS_MART = ["items_daily_base", "items_mart"]


class ConstraintViolation(ValueError):
    """Raised by a strict refresh where a declared constraint does not hold."""


def _require_none(report: DataFrame, what: str) -> None:
    """Stop at the first report with rows, naming their number and some of them."""
    total = report.count()
    if total:
        shown = "; ".join(str(tuple(row)) for row in report.limit(10).collect())
        raise ConstraintViolation(f"{what} ({total} in all): {shown}")


def _write_steps(
    spark: SparkSession, steps: list[list[list[str]]], write: Callable[[str], None]
) -> None:
    # Job group, scheduler pool and cancellation of the caller hold for the writes too.
    @inheritable_thread_target(spark)
    def write_chain(chain: list[str]) -> None:
        for table in chain:
            write(table)

    with freed_shuffles(spark), ThreadPoolExecutor() as pool:
        for step in steps:
            list(pool.map(write_chain, step))


def load_staging(
    spark: SparkSession, raw_path: str, root: str, resume: bool = False
) -> Warehouse:
    """Begin a new version of the warehouse with the order lines found at ``raw_path``.

    With ``resume`` a version that was begun from the same path, and not finished, is taken up again.
    """
    with tuned(spark):
        if resume:
            target = Warehouse.unfinished(spark, root)
            if target is not None and target.entries.get(STAGED, (0, None))[1] == raw_path:
                return target
        rows = stage(read_order_lines(spark, raw_path))
        target = Warehouse.begin(spark, root)
        target.write(STAGED, rows, source=raw_path)
    return target


def build_core(
    spark: SparkSession,
    root: str,
    previous: str | None = None,
    strict: bool = False,
    max_shuffle_partitions: int | None = None,
    resume: bool = False,
) -> Warehouse:
    """Build dimensions and facts of the version begun last.

    Users and drivers are merged into those of the last complete version, or, where the warehouse has
    none, of the warehouse ``previous``. With ``resume`` tables the version already has stay.
    """
    target = Warehouse.begun(spark, root)
    earlier = Warehouse.current(spark, root)
    if earlier is None and previous:
        earlier = Warehouse.current(spark, previous)
        if earlier is None:
            raise ValueError(f"{previous} has no complete version")
    staged = target[STAGED]
    merges = {"dim_user": dimensions.dim_user, "dim_driver": dimensions.dim_driver}

    def write(table: str) -> None:
        if resume and table in target.entries:
            return
        if table in merges:
            rows = merges[table](earlier[table] if earlier else None, staged)
        else:
            rows = BUILD[table](target)
        target.write(table, rows)

    with tuned(spark, shuffle_partitions(staged, max_shuffle_partitions)), scratch(spark):
        if strict:
            _require_none(quality.upsert_conflicts(staged), "conflicting rows for one id")
        _write_steps(spark, CORE_STEPS, write)
        if strict:
            duplicates, nulls, orphans = quality.constraint_reports(target)
            _require_none(duplicates, "duplicate keys")
            _require_none(nulls.filter("null_rows > 0"), "NULL in a NOT NULL column")
            _require_none(orphans.filter("orphan_rows > 0"), "rows without a parent")
    return target


def build_marts(
    spark: SparkSession,
    root: str,
    marts: list[list[str]] | None = None,
    max_shuffle_partitions: int | None = None,
    resume: bool = False,
) -> Warehouse:
    """Build the daily item sales and both marts, or the given ones, of the version begun last.

    With ``resume`` tables the version already has stay.
    """
    target = Warehouse.begun(spark, root)
    lines = target["fact_order_item"]
    steps = [[["placed_order"]], marts or [ORDERS_MART, ITEMS_MART]]

    def write(table: str) -> None:
        if not (resume and table in target.entries):
            target.write(table, BUILD[table](target))

    with tuned(spark, shuffle_partitions(lines, max_shuffle_partitions)), scratch(spark):
        _write_steps(spark, steps, write)
    return target


def publish(spark: SparkSession, root: str) -> Warehouse:
    """Make the version begun last the one readers see; all its tables have to be entered as whole."""
    target = Warehouse.begun(spark, root)
    target.finish()
    return target


def refresh(
    spark: SparkSession,
    raw_path: str,
    root: str,
    previous: str | None = None,
    strict: bool = False,
    max_shuffle_partitions: int | None = None,
    resume: bool = False,
) -> Warehouse:
    """Build a new version of a warehouse from raw order lines and make it the current one.

    All tables are rebuilt from this batch; users and drivers of the last complete version are carried
    over (``previous`` names another warehouse to begin with). Until the last step readers see the
    version before, and after a failure they still do; the refresh is then simply repeated, or with
    ``resume`` taken up after the tables that were written whole. With ``strict`` the first broken
    constraint ends the run before any mart is written. The session's settings are the same afterwards
    and nothing stays in the working folder.
    """
    load_staging(spark, raw_path, root, resume)
    build_core(spark, root, previous, strict, max_shuffle_partitions, resume)
    build_marts(spark, root, None, max_shuffle_partitions, resume)
    return publish(spark, root)


def audit(tables: Warehouse) -> DataFrame:
    """Row counts of the facts, counted from what is stored."""
    return facts.row_counts({name: tables[name] for name in FACTS})


def recorded_counts(built: Warehouse) -> DataFrame:
    """The same from the entries of a refresh, which counted its rows while it wrote them."""
    return built.row_counts(FACTS)
