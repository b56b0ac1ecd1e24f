"""Declared tables: columns, types and constraints.

Column names, types and constraints are fixed values of the data model; every table that is
written or read goes through them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DELIVERY_RAW = {
    "order_id": "bigint",
    "user_id": "bigint",
    "user_phone": "string",
    "driver_id": "bigint",
    "driver_phone": "string",
    "address_text": "string",
    "store_id": "bigint",
    "store_address": "string",
    "payment_type": "string",
    "order_cancellation_reason": "string",
    "created_at": "timestamp_ntz",
    "paid_at": "timestamp_ntz",
    "delivery_started_at": "timestamp_ntz",
    "delivered_at": "timestamp_ntz",
    "canceled_at": "timestamp_ntz",
    "order_discount": "decimal(10,2)",
    "delivery_cost": "decimal(10,2)",
    "item_id": "bigint",
    "item_title": "string",
    "item_category": "string",
    "item_quantity": "int",
    "item_canceled_quantity": "int",
    "item_price": "decimal(10,2)",
    "item_discount": "decimal(10,2)",
    "item_replaced_id": "bigint",
}

DIMENSIONS = {
    "dim_user": {"user_id": "bigint", "user_phone": "string"},
    "dim_driver": {"driver_id": "bigint", "driver_phone": "string"},
    "dim_category": {"category_id": "bigint", "category_name": "string"},
    "dim_payment_type": {"payment_type_id": "bigint", "payment_type_name": "string"},
    "dim_cancellation_reason": {
        "cancellation_reason_id": "bigint",
        "cancellation_reason_name": "string",
        "is_service_fault": "boolean",
    },
    "dim_city": {"city_id": "bigint", "city_name": "string"},
    "dim_address": {
        "address_id": "bigint",
        "city_id": "bigint",
        "full_address": "string",
        "address_type": "string",
    },
    "dim_store": {"store_id": "bigint", "store_address_id": "bigint"},
    "dim_item": {"item_id": "bigint", "item_title": "string", "category_id": "bigint"},
}

FACTS = {
    "fact_order": {
        "order_id": "bigint",
        "user_id": "bigint",
        "delivery_address_id": "bigint",
        "store_id": "bigint",
        "payment_type_id": "bigint",
        "cancellation_reason_id": "bigint",
        "created_at": "timestamp_ntz",
        "paid_at": "timestamp_ntz",
        "delivery_started_at": "timestamp_ntz",
        "delivered_at": "timestamp_ntz",
        "canceled_at": "timestamp_ntz",
        "order_discount_pct": "decimal(10,2)",
        "delivery_cost": "decimal(10,2)",
        "is_canceled": "boolean",
        "is_delivered": "boolean",
    },
    "fact_order_item": {
        "order_id": "bigint",
        "item_id": "bigint",
        "ordered_quantity": "int",
        "canceled_quantity": "int",
        "item_price": "decimal(10,2)",
        "item_discount_pct": "decimal(10,2)",
        "replaced_by_item_id": "bigint",
    },
    "fact_order_driver_assignment": {
        "order_id": "bigint",
        "driver_id": "bigint",
        "assigned_at": "timestamp_ntz",
        "unassigned_at": "timestamp_ntz",
        "delivered_at_by_driver": "timestamp_ntz",
    },
}

PLACED_ORDER = {
    "order_id": "bigint",
    "user_id": "bigint",
    "report_date": "date",
    "city_id": "bigint",
    "store_id": "bigint",
    "cancellation_reason_id": "bigint",
    "delivery_cost": "decimal(10,2)",
    "is_canceled": "boolean",
    "is_delivered": "boolean",
    "has_delivery_time": "boolean",
}

ITEMS_DAILY_BASE = {
    "report_date": "date",
    "year_num": "int",
    "month_num": "int",
    "day_num": "int",
    "week_start": "date",
    "month_start": "date",
    "city_name": "string",
    "store_id": "bigint",
    "category_name": "string",
    "item_id": "bigint",
    "item_title": "string",
    "item_gmv": "decimal(24,6)",
    "ordered_units": "bigint",
    "canceled_units": "bigint",
    "orders_with_item_cnt": "bigint",
    "orders_with_item_cancellation_cnt": "bigint",
}

MARTS = {
    "orders_mart": {
        "report_date": "date",
        "year_num": "int",
        "month_num": "int",
        "day_num": "int",
        "city_name": "string",
        "store_id": "bigint",
        "gmv": "decimal(18,2)",
        "revenue": "decimal(18,2)",
        "profit": "decimal(18,2)",
        "created_orders_cnt": "bigint",
        "delivered_orders_cnt": "bigint",
        "canceled_orders_cnt": "bigint",
        "canceled_after_delivery_cnt": "bigint",
        "canceled_service_fault_cnt": "bigint",
        "customers_cnt": "bigint",
        "avg_check": "decimal(18,2)",
        "orders_per_customer": "decimal(18,4)",
        "revenue_per_customer": "decimal(18,2)",
        "courier_change_orders_cnt": "bigint",
        "active_drivers_cnt": "bigint",
    },
    "items_mart": {
        "report_date": "date",
        "year_num": "int",
        "month_num": "int",
        "day_num": "int",
        "city_name": "string",
        "store_id": "bigint",
        "category_name": "string",
        "item_id": "bigint",
        "item_title": "string",
        "item_gmv": "decimal(18,2)",
        "ordered_units": "bigint",
        "canceled_units": "bigint",
        "orders_with_item_cnt": "bigint",
        "orders_with_item_cancellation_cnt": "bigint",
        "popularity_rank_day": "bigint",
        "popularity_rank_week": "bigint",
        "popularity_rank_month": "bigint",
        "anti_popularity_rank_day": "bigint",
        "anti_popularity_rank_week": "bigint",
        "anti_popularity_rank_month": "bigint",
    },
}

TABLES = {
    "delivery_raw": DELIVERY_RAW,
    **DIMENSIONS,
    **FACTS,
    "placed_order": PLACED_ORDER,
    "items_daily_base": ITEMS_DAILY_BASE,
    **MARTS,
}

# Unique keys: primary keys first, then the other unique column sets.
UNIQUE_KEYS = [
    ("dim_user", ["user_id"]),
    ("dim_driver", ["driver_id"]),
    ("dim_category", ["category_id"]),
    ("dim_payment_type", ["payment_type_id"]),
    ("dim_cancellation_reason", ["cancellation_reason_id"]),
    ("dim_city", ["city_id"]),
    ("dim_address", ["address_id"]),
    ("dim_store", ["store_id"]),
    ("dim_item", ["item_id"]),
    ("fact_order", ["order_id"]),
    ("dim_category", ["category_name"]),
    ("dim_payment_type", ["payment_type_name"]),
    ("dim_cancellation_reason", ["cancellation_reason_name"]),
    ("dim_city", ["city_name"]),
    ("dim_address", ["full_address", "address_type"]),
]

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("dim_address", "city_id", "dim_city", "city_id"),
    ("dim_store", "store_address_id", "dim_address", "address_id"),
    ("dim_item", "category_id", "dim_category", "category_id"),
    ("fact_order", "user_id", "dim_user", "user_id"),
    ("fact_order", "delivery_address_id", "dim_address", "address_id"),
    ("fact_order", "store_id", "dim_store", "store_id"),
    ("fact_order", "payment_type_id", "dim_payment_type", "payment_type_id"),
    (
        "fact_order",
        "cancellation_reason_id",
        "dim_cancellation_reason",
        "cancellation_reason_id",
    ),
    ("fact_order_item", "order_id", "fact_order", "order_id"),
    ("fact_order_item", "item_id", "dim_item", "item_id"),
    ("fact_order_driver_assignment", "order_id", "fact_order", "order_id"),
    ("fact_order_driver_assignment", "driver_id", "dim_driver", "driver_id"),
]

NOT_NULL = {
    "dim_category": ["category_name"],
    "dim_payment_type": ["payment_type_name"],
    "dim_cancellation_reason": ["cancellation_reason_name", "is_service_fault"],
    "dim_city": ["city_name"],
    "dim_address": ["city_id", "full_address", "address_type"],
    "dim_store": ["store_address_id"],
    "dim_item": ["item_title", "category_id"],
    "fact_order_item": ["order_id", "item_id"],
    "fact_order_driver_assignment": ["order_id", "driver_id"],
}


def ddl(table: str) -> str:
    """Schema string of a declared table, as accepted by ``spark.read.schema``."""
    return ", ".join(f"{name} {kind}" for name, kind in TABLES[table].items())


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns in order, cast to the declared types."""
    return df.select(*(F.col(name).cast(kind).alias(name) for name, kind in TABLES[table].items()))
