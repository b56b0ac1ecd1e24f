"""Fact tables and their row-count audit."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dimensions import DELIVERY


def fact_order(
    staged: DataFrame,
    addresses: DataFrame,
    payment_types: DataFrame,
    reasons: DataFrame,
) -> DataFrame:
    """One row per order, from its lines that carry a known delivery address.

    Lines are folded per order and looked-up text first. All measures are minima and maxima, so
    folding again after the lookups gives the same result, and the text joins run on about one
    row per order instead of one per line. Text stays in the grouping keys: a max over text
    would force a sort-based aggregation.
    """
    texts = ["address_text", "payment_type", "order_cancellation_reason"]
    measures = {
        "user_id": F.max,
        "store_id": F.max,
        "created_at": F.min,
        "paid_at": F.max,
        "delivery_started_at": F.min,
        "delivered_at": F.max,
        "canceled_at": F.max,
        "order_discount_pct": F.max,
        "delivery_cost": F.max,
    }
    no_amount = F.lit(0).cast("decimal(10,2)")
    folded = (
        staged.filter(F.col("order_id").isNotNull() & F.col("address_text").isNotNull())
        .withColumn("order_discount_pct", F.coalesce("order_discount", no_amount))
        .withColumn("delivery_cost", F.coalesce("delivery_cost", no_amount))
        .groupBy("order_id", *texts)
        .agg(*(fold(name).alias(name) for name, fold in measures.items()))
    )
    places = addresses.filter(F.col("address_type") == DELIVERY).select(
        F.col("full_address").alias("address_text"),
        F.col("address_id").alias("delivery_address_id"),
    )
    payments = payment_types.select(
        F.col("payment_type_name").alias("payment_type"), "payment_type_id"
    )
    cancellations = reasons.select(
        F.col("cancellation_reason_name").alias("order_cancellation_reason"),
        "cancellation_reason_id",
    )
    keys = ["delivery_address_id", "payment_type_id", "cancellation_reason_id"]
    orders = (
        folded.join(places, "address_text")
        .join(payments, "payment_type", "left")
        .join(cancellations, "order_cancellation_reason", "left")
        .groupBy("order_id")
        .agg(
            *(F.max(key).alias(key) for key in keys),
            *(fold(name).alias(name) for name, fold in measures.items()),
        )
    )
    return orders.select(
        "order_id",
        "user_id",
        "delivery_address_id",
        "store_id",
        "payment_type_id",
        "cancellation_reason_id",
        "created_at",
        "paid_at",
        "delivery_started_at",
        "delivered_at",
        "canceled_at",
        "order_discount_pct",
        "delivery_cost",
        F.col("canceled_at").isNotNull().alias("is_canceled"),
        F.col("delivered_at").isNotNull().alias("is_delivered"),
    )


def fact_order_item(staged: DataFrame) -> DataFrame:
    """One row per staged line with an order and an item; repeated lines stay."""
    no_amount = F.lit(0).cast("decimal(10,2)")
    return staged.filter(F.col("order_id").isNotNull() & F.col("item_id").isNotNull()).select(
        "order_id",
        "item_id",
        F.coalesce("item_quantity", F.lit(0)).alias("ordered_quantity"),
        F.coalesce("item_canceled_quantity", F.lit(0)).alias("canceled_quantity"),
        F.coalesce("item_price", no_amount).alias("item_price"),
        F.coalesce("item_discount", no_amount).alias("item_discount_pct"),
        F.col("item_replaced_id").alias("replaced_by_item_id"),
    )


def fact_order_driver_assignment(staged: DataFrame) -> DataFrame:
    """Distinct driver assignments; unassigned means canceled before any delivery."""
    undelivered = F.col("delivered_at").isNull()
    return (
        staged.filter(F.col("order_id").isNotNull() & F.col("driver_id").isNotNull())
        .select(
            "order_id",
            "driver_id",
            F.col("delivery_started_at").alias("assigned_at"),
            F.when(undelivered, F.col("canceled_at")).alias("unassigned_at"),
            F.col("delivered_at").alias("delivered_at_by_driver"),
        )
        .distinct()
    )


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = (
        df.agg(F.count("*").alias("row_cnt")).select(F.lit(name).alias("table_name"), "row_cnt")
        for name, df in tables.items()
    )
    return reduce(DataFrame.unionByName, counts)
