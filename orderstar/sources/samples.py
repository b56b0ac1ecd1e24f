"""Order lines derived from the TPC-H-like test tables (the mapping of FIXTURES.md).

The clean lines satisfy every constraint; the dirty ones break each that can break.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import gathered


def _tables(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{folder}/{name}.parquet") for name in names]


def _choose(value: Column, options: list[str], last: str | None) -> Column:
    """Option i where value = i, ``last`` otherwise."""
    chosen = F.when(value == 0, options[0])
    for i, option in enumerate(options[1:], 1):
        chosen = chosen.when(value == i, option)
    return chosen.otherwise(last)


def _text(number: Column) -> Column:
    return number.cast("string")


def _minutes_after(start: Column, minutes: Column | int) -> Column:
    mins = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return start + F.make_dt_interval(mins=mins.cast("int"))


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    lineitem, orders, customer, nation, region, part = _tables(
        spark, folder, "lineitem", "orders", "customer", "nation", "region", "part"
    )
    c = F.col
    order, user, line, status = (
        c("l_orderkey"),
        c("o_custkey"),
        c("l_linenumber"),
        c("o_orderstatus"),
    )
    # Orders find their customer, and lines their part, before the two meet: large inputs shuffle the
    # lines twice instead of three times, and the lines of an order stay together for what follows.
    placed_by = (
        orders.join(customer, c("c_custkey") == user)
        .join(nation, c("n_nationkey") == c("c_nationkey"))
        .join(region, c("r_regionkey") == c("n_regionkey"))
    )
    lines = gathered(lineitem, "l_quantity", "l_discount", "l_returnflag", "l_linenumber")
    sold = gathered(lines.join(part, c("p_partkey") == c("l_partkey")), "p_name", "p_type")
    joined = sold.join(placed_by, c("o_orderkey") == order)
    # Lines of an order are written one after the other, as a source writes them: what an order has
    # once is then stored about once.
    joined = joined.sortWithinPartitions(order)
    even_line = line % 2 == 0
    no_driver = order % 23 == 0
    canceled = (status == "P") | ((status == "O") & (order % 11 == 0))
    second_driver = (order % 10 == 3) & even_line
    driver = order % 97 + F.when(second_driver, 2).otherwise(1)
    placed = _minutes_after(
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"), order * 7919 % 129600
    )
    home = F.concat(
        F.when(user % 5 == 0, " ").otherwise(""),
        c("r_name"),
        F.when(user % 7 == 0, " ").otherwise(""),
        F.lit(", Street "),
        _text(user),
    )
    store = order % 4 + 1
    store_city = _choose(order % 4, ["ASIA", "EUROPE", "AFRICA"], "AMERICA")
    reason = _choose(
        order % 5,
        [
            "Ошибка приложения",
            "Проблемы с оплатой",
            "Customer changed mind",
            "Out of stock",
        ],
        None,
    )
    units = c("l_quantity").cast("int")
    columns = {
        "order_id": order,
        "user_id": user,
        "user_phone": F.when(
            user % 9 != 0, F.concat(F.lit("+7"), F.lpad(_text(user), 10, "0"))
        ),
        "driver_id": F.when(~no_driver, driver),
        "driver_phone": F.when(
            ~no_driver, F.concat(F.lit("+8"), F.lpad(_text(driver), 10, "0"))
        ),
        "address_text": F.when(
            (order % 17 == 0) & even_line, F.concat(F.lit("MIDDLE EAST, Alt "), _text(user))
        ).otherwise(home),
        "store_id": store,
        "store_address": F.concat(
            F.lit("Store "), _text(store), F.lit(", "), store_city, F.lit(", Main st")
        ),
        "payment_type": F.when(order % 13 != 0, c("o_orderpriority")),
        "order_cancellation_reason": F.when(canceled, reason),
        "created_at": placed,
        "paid_at": _minutes_after(placed, 2),
        "delivery_started_at": F.when(
            ~no_driver, _minutes_after(placed, F.when(second_driver, 35).otherwise(20))
        ),
        "delivered_at": F.when(status.isin("F", "O"), _minutes_after(placed, 60)),
        "canceled_at": F.when(canceled, _minutes_after(placed, 90)),
        "order_discount": F.when(order % 4 != 0, (order % 4 * 5).cast("decimal(10,2)")),
        "delivery_cost": F.when(order % 19 != 0, (order % 50 + 99).cast("decimal(10,2)")),
        "item_id": c("l_partkey"),
        "item_title": c("p_name"),
        "item_category": c("p_type"),
        "item_quantity": units,
        "item_canceled_quantity": F.when(status == "P", units).when(
            c("l_returnflag") == "R", 1
        ),
        "item_price": c("p_retailprice").cast("decimal(10,2)"),
        "item_discount": F.when(
            c("l_discount") != 0, (c("l_discount") * 100).cast("decimal(10,2)")
        ),
        "item_replaced_id": F.when(
            (c("l_returnflag") == "A") & even_line, c("l_partkey") + 1
        ),
    }
    return joined.select(*(value.alias(name) for name, value in columns.items()))


def dirty_order_lines(lines: DataFrame) -> DataFrame:
    """The same lines with faults injected."""
    c = F.col
    order, user, driver, item = c("order_id"), c("user_id"), c("driver_id"), c("item_id")
    even = order % 2 == 0
    unknown_store = order % 211 == 0
    faults = {
        "order_id": F.when(order % 997 == 2, None).otherwise(order),
        "user_phone": F.when((user % 50 == 7) & even, "+70000000000").otherwise(c("user_phone")),
        "driver_phone": F.when((driver % 40 == 7) & even, "+80000000000").otherwise(
            c("driver_phone")
        ),
        "address_text": F.when(order % 499 == 1, None).otherwise(c("address_text")),
        "store_id": F.when(unknown_store, 5).otherwise(c("store_id")),
        "store_address": F.when(unknown_store, "Store 5, NOWHERE, Main st")
        .when(order % 300 == 1, "Store 2b, EUROPE, Alt st")
        .otherwise(c("store_address")),
        "item_title": F.when(item % 90 == 9, None)
        .when((item % 80 == 5) & even, F.concat("item_title", F.lit(" v2")))
        .otherwise(c("item_title")),
        "item_category": F.when(item % 100 == 3, None).otherwise(c("item_category")),
    }
    return lines.withColumns(faults)


def mistyped_order_lines(lines: DataFrame) -> DataFrame:
    """The same lines from a writer without types: text, doubles, and values that do not fit."""
    c = F.col
    order, user, item = c("order_id"), c("user_id"), c("item_id")
    faults = {
        "user_id": F.when(user % 113 == 5, F.lit("100000000000000000000").cast("decimal(38,0)")).otherwise(
            user.cast("decimal(38,0)")
        ),
        "created_at": F.when(order % 107 == 3, "yesterday").otherwise(c("created_at").cast("string")),
        "order_discount": F.when(order % 109 == 4, "").otherwise(c("order_discount").cast("string")),
        "item_quantity": F.when(order % 101 == 1, "many")
        .when(order % 103 == 2, "99999999999")
        .otherwise(c("item_quantity").cast("string")),
        "item_price": F.when(item % 97 == 1, float("nan"))
        .when(item % 89 == 2, 1e12)
        .otherwise(c("item_price").cast("double")),
        "item_replaced_id": c("item_replaced_id") > 0,
    }
    return lines.withColumns(faults)


def existing_users(spark: SparkSession, folder: str) -> DataFrame:
    (customer,) = _tables(spark, folder, "customer")
    key = F.col("c_custkey")
    return customer.select(
        (key * 2).alias("user_id"), F.concat(F.lit("old-"), _text(key)).alias("user_phone")
    )


def existing_drivers(spark: SparkSession, folder: str) -> DataFrame:
    (supplier,) = _tables(spark, folder, "supplier")
    key = F.col("s_suppkey")
    return supplier.select(
        (key * 20 + 1).alias("driver_id"), F.concat(F.lit("old-"), _text(key)).alias("driver_phone")
    )
