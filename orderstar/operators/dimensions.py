"""Conformed dimensions.

Every builder reduces the staged lines to the distinct values it needs before it joins anything,
so the joins are between dimension-sized frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import address_part
from .keys import with_dense_key

# Cancellation reasons that count as the service's own fault.
SERVICE_FAULT_REASONS = ("Ошибка приложения", "Проблемы с оплатой")

DELIVERY = "delivery"
STORE = "store"


def _values(staged: DataFrame, source: str, name: str) -> DataFrame:
    return staged.filter(F.col(source).isNotNull()).select(F.col(source).alias(name)).distinct()


def type1_merge(
    existing: DataFrame | None, incoming: DataFrame, key: str, attribute: str
) -> DataFrame:
    """Upsert: incoming rows replace existing ones with the same key, all other rows stay.

    Incoming rows are made distinct, then old and new rows meet in one aggregation: the incoming flag
    decides first, then the greatest value, so NULL only wins where no incoming row has a value.
    """
    new = (
        incoming.filter(F.col(key).isNotNull())
        .select(key, attribute)
        .distinct()
        .withColumn("_new", F.lit(True))
    )
    if existing is not None:
        new = new.unionByName(existing.select(key, attribute).withColumn("_new", F.lit(False)))
    best = F.max(F.struct("_new", attribute))
    return new.groupBy(key).agg(best[attribute].alias(attribute))


def dim_user(existing: DataFrame | None, staged: DataFrame) -> DataFrame:
    return type1_merge(existing, staged, "user_id", "user_phone")


def dim_driver(existing: DataFrame | None, staged: DataFrame) -> DataFrame:
    return type1_merge(existing, staged, "driver_id", "driver_phone")


def dim_category(staged: DataFrame) -> DataFrame:
    names = _values(staged, "item_category", "category_name")
    return with_dense_key(names, "category_id", ["category_name"])


def dim_payment_type(staged: DataFrame) -> DataFrame:
    names = _values(staged, "payment_type", "payment_type_name")
    return with_dense_key(names, "payment_type_id", ["payment_type_name"])


def dim_cancellation_reason(
    staged: DataFrame, fault_reasons: tuple[str, ...] = SERVICE_FAULT_REASONS
) -> DataFrame:
    names = _values(staged, "order_cancellation_reason", "cancellation_reason_name")
    return with_dense_key(
        names, "cancellation_reason_id", ["cancellation_reason_name"]
    ).withColumn("is_service_fault", F.col("cancellation_reason_name").isin(*fault_reasons))


def dim_city(staged: DataFrame) -> DataFrame:
    """Cities of delivery addresses (the first address part); store cities add none."""
    names = _values(staged, "address_text", "address").select(
        address_part("address", 1).alias("city_name")
    )
    return with_dense_key(names.distinct(), "city_id", ["city_name"])


def dim_address(staged: DataFrame, cities: DataFrame) -> DataFrame:
    """Delivery addresses, then store addresses whose city (the second part) is a known city."""

    def located(source: str, city_part: int, kind: str) -> DataFrame:
        addresses = _values(staged, source, "full_address")
        return (
            addresses.withColumn("city_name", address_part("full_address", city_part))
            .join(cities, "city_name")
            .select("city_id", "full_address", F.lit(kind).alias("address_type"))
        )

    rows = located("address_text", 1, DELIVERY).unionByName(located("store_address", 2, STORE))
    return with_dense_key(rows, "address_id", ["address_type", "full_address"])


def dim_store(staged: DataFrame, addresses: DataFrame) -> DataFrame:
    """Stores with a known address; a store seen at two addresses keeps both rows."""
    stores = (
        staged.filter(F.col("store_id").isNotNull() & F.col("store_address").isNotNull())
        .select("store_id", F.col("store_address").alias("full_address"))
        .distinct()
    )
    places = addresses.filter(F.col("address_type") == STORE).select(
        "full_address", F.col("address_id").alias("store_address_id")
    )
    return stores.join(places, "full_address").select("store_id", "store_address_id")


def dim_item(staged: DataFrame, categories: DataFrame) -> DataFrame:
    """Items with a category; an item seen with two titles or categories keeps every row."""
    items = (
        staged.filter(F.col("item_id").isNotNull() & F.col("item_category").isNotNull())
        .select("item_id", "item_title", F.col("item_category").alias("category_name"))
        .distinct()
    )
    return items.join(categories, "category_name").select("item_id", "item_title", "category_id")
