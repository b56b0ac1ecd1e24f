"""Daily order economics per delivery city and store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import calendar, discounted_sum, ratio
from ..schemas import conform

_GROUP = ["report_date", "city_id", "store_id"]


def placed_order(orders: DataFrame, addresses: DataFrame) -> DataFrame:
    """Orders with their day and delivery city: what both marts need of them, found once."""
    places = addresses.select(F.col("address_id").alias("delivery_address_id"), "city_id")
    joined = orders.join(places, "delivery_address_id")
    return conform(
        joined.select(
            "*",
            F.to_date("created_at").alias("report_date"),
            F.col("delivered_at").isNotNull().alias("has_delivery_time"),
        ),
        "placed_order",
    )


def order_item_metrics(order_items: DataFrame) -> DataFrame:
    """Per order: gross value of all units, and revenue of the units not canceled."""
    kept = F.col("ordered_quantity") - F.col("canceled_quantity")
    return order_items.groupBy("order_id").agg(
        discounted_sum(F.col("ordered_quantity")).alias("gmv"),
        discounted_sum(kept).alias("revenue"),
    )


def order_driver_stats(assignments: DataFrame) -> DataFrame:
    """Per order: the number of different drivers."""
    return assignments.groupBy("order_id").agg(
        F.count_distinct("driver_id").alias("driver_cnt")
    )


def _distinct_per_group(rows: DataFrame, column: str, count: Column) -> DataFrame:
    """One row per group and different value; repeated values combine before the shuffle."""
    values = rows.groupBy(*_GROUP, column).agg(count.alias("_rows"))
    seen = F.col(column).isNotNull() & (F.col("_rows") > 0)
    return values.select(*_GROUP, seen.alias(f"{column}_seen"))


def orders_mart(
    placed: DataFrame,
    order_items: DataFrame,
    assignments: DataFrame,
    cities: DataFrame,
    reasons: DataFrame,
    fan_out: bool = True,
) -> DataFrame:
    """Aggregate orders per day, delivery city and store.

    By default amounts count once per driver assignment of the order (the model's own definition);
    ``fan_out=False`` counts them once per order.

    The measures come from one row per order: order counts are plain conditional counts, amounts are
    multiplied by the number of assignments. Different users and drivers of a group join them as rows
    of their own, so one aggregation per group adds up everything. Assignments are folded per (order,
    driver) before they meet per order, so a hot order is no hot task, and both uses of them share these
    shuffles. Grouping uses the city id; names are attached to the finished groups.
    """
    pairs = (
        assignments.filter("order_id IS NOT NULL")
        .groupBy("order_id", "driver_id")
        .agg(F.count("*").alias("times"))
        .repartition("order_id")
    )
    drivers = pairs.groupBy("order_id").agg(
        F.sum("times").cast("int").alias("assignment_cnt"), F.count("driver_id").alias("driver_cnt")
    )
    times = F.coalesce(F.col("assignment_cnt"), F.lit(1)) if fan_out else F.lit(1)
    faults = reasons.filter("is_service_fault").select(
        "cancellation_reason_id", F.lit(True).alias("service_fault")
    )
    rows = (
        placed.join(faults, "cancellation_reason_id", "left")
        .join(order_item_metrics(order_items), "order_id", "left")
        .join(drivers, "order_id", "left")
    )
    canceled = F.col("is_canceled")
    measures = rows.select(
        *_GROUP,
        (F.col("gmv") * times).alias("gmv"),
        (F.col("revenue") * times).alias("revenue"),
        (F.col("delivery_cost") * times).alias("cost"),
        F.lit(True).alias("created"),
        F.col("is_delivered").alias("delivered"),
        canceled.alias("canceled"),
        (canceled & F.col("has_delivery_time")).alias("canceled_after_delivery"),
        (canceled & F.col("service_fault")).alias("canceled_service_fault"),
        (F.col("driver_cnt") > 1).alias("courier_change"),
    )
    # Drivers are counted with ``times`` so that the folded pairs are the same frame as above.
    active = pairs.join(placed.select("order_id", *_GROUP), "order_id")
    different = [
        _distinct_per_group(placed, "user_id", F.count("*")),
        _distinct_per_group(active, "driver_id", F.sum("times")),
    ]
    for values in different:
        measures = measures.unionByName(values, allowMissingColumns=True)
    counted = measures.groupBy(*_GROUP).agg(
        *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("gmv", "revenue", "cost")),
        F.count_if("created").alias("created_orders_cnt"),
        F.count_if("delivered").alias("delivered_orders_cnt"),
        F.count_if("canceled").alias("canceled_orders_cnt"),
        F.count_if("canceled_after_delivery").alias("canceled_after_delivery_cnt"),
        F.count_if("canceled_service_fault").alias("canceled_service_fault_cnt"),
        F.count_if("courier_change").alias("courier_change_orders_cnt"),
        F.count_if("user_id_seen").alias("customers_cnt"),
        F.count_if("driver_id_seen").alias("active_drivers_cnt"),
    )
    named = counted.join(cities, "city_id").select(
        *calendar("report_date"),
        *(c for c in counted.columns if c not in ("report_date", "city_id")),
        "city_name",
        (F.col("revenue") - F.col("cost")).alias("profit"),
        ratio(F.col("revenue"), F.col("delivered_orders_cnt")).alias("avg_check"),
        ratio(F.col("created_orders_cnt"), F.col("customers_cnt")).alias("orders_per_customer"),
        ratio(F.col("revenue"), F.col("customers_cnt")).alias("revenue_per_customer"),
    )
    return conform(named, "orders_mart")
