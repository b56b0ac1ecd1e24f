"""The definitions of the marts on a few rows each, results worked out by hand."""

from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from orderstar.functions.columns import ratio
from orderstar.operators import items_mart as im
from orderstar.operators.orders_mart import orders_mart, placed_order

from .helpers import table


def dims_of(spark):
    return {
        "cities": table(spark, "dim_city", {"city_id": 1, "city_name": "Riga"}, {"city_id": 2, "city_name": "Oslo"}),
        "addresses": table(
            spark,
            "dim_address",
            {"address_id": 1, "city_id": 1, "full_address": "Riga, 1", "address_type": "delivery"},
            {"address_id": 2, "city_id": 2, "full_address": "Oslo, 1", "address_type": "delivery"},
            {"address_id": 3, "city_id": 2, "full_address": "S, Oslo", "address_type": "store"},
        ),
        "reasons": table(
            spark,
            "dim_cancellation_reason",
            {"cancellation_reason_id": 1, "cancellation_reason_name": "f", "is_service_fault": True},
            {"cancellation_reason_id": 2, "cancellation_reason_name": "o", "is_service_fault": False},
        ),
    }


def order(i, **more):
    more = {"delivery_cost": 0, "is_canceled": False, "is_delivered": False, **more}
    if more["is_delivered"]:
        more.setdefault("delivered_at", "2024-01-05 10:00:00")
    return {
        "order_id": i,
        "user_id": i,
        "delivery_address_id": 1,
        "store_id": 1,
        "created_at": "2024-01-05 09:00:00",
        **more,
    }


def line(order_id, quantity, price, pct=0, canceled=0, item=1):
    return {
        "order_id": order_id,
        "item_id": item,
        "ordered_quantity": quantity,
        "canceled_quantity": canceled,
        "item_price": price,
        "item_discount_pct": pct,
    }


def mart(spark, orders, lines=(), assignments=(), **options):
    d = dims_of(spark)
    built = orders_mart(
        placed_order(table(spark, "fact_order", *orders), d["addresses"]),
        table(spark, "fact_order_item", *lines),
        table(spark, "fact_order_driver_assignment", *assignments),
        d["cities"],
        d["reasons"],
        **options,
    )
    return built.collect()


def test_amounts_count_once_per_assignment_but_orders_once(spark):
    orders = [order(1, is_delivered=True, delivery_cost=10)]
    lines = [line(1, 2, "50", pct=10, canceled=1), line(1, 1, "10")]
    drivers = [
        {"order_id": 1, "driver_id": 7, "assigned_at": "2024-01-05 09:00:00"},
        {"order_id": 1, "driver_id": 7, "assigned_at": "2024-01-05 09:10:00"},
        {"order_id": 1, "driver_id": 8, "assigned_at": "2024-01-05 09:20:00"},
    ]
    (row,) = mart(spark, orders, lines, drivers)
    # gmv 2*50*0.9 + 10 = 100, revenue 45 + 10 = 55, three assignment rows
    assert (row.gmv, row.revenue, row.profit) == (Decimal(300), Decimal(165), Decimal(135))
    assert (row.created_orders_cnt, row.delivered_orders_cnt, row.customers_cnt) == (1, 1, 1)
    assert (row.courier_change_orders_cnt, row.active_drivers_cnt) == (1, 2)
    assert row.avg_check == Decimal(165) and row.revenue_per_customer == Decimal(165)

    (once,) = mart(spark, orders, lines, drivers, fan_out=False)
    assert (once.gmv, once.revenue, once.profit) == (Decimal(100), Decimal(55), Decimal(45))
    assert (once.created_orders_cnt, once.active_drivers_cnt) == (1, 2)


def test_average_check_divides_all_revenue_by_delivered_orders(spark):
    lines = [line(1, 1, "10"), line(2, 1, "20"), line(3, 1, "1")]
    (row,) = mart(spark, [order(1, is_delivered=True), order(2), order(3, user_id=1)], lines)
    assert row.avg_check == Decimal(31)
    assert row.orders_per_customer == Decimal("1.5000")
    assert row.revenue_per_customer == Decimal("15.50")


def test_ratios_are_null_without_delivered_orders_or_users(spark):
    (row,) = mart(spark, [order(1, user_id=None)])
    assert row.avg_check is None
    assert row.orders_per_customer is None and row.revenue_per_customer is None
    assert (row.customers_cnt, row.created_orders_cnt) == (0, 1)


def test_ratios_are_rounded_once(spark):
    wide = F.lit("1034.999999").cast("decimal(38,8)")
    got = spark.range(1).select(
        ratio(wide, F.lit(1000)).cast("decimal(18,2)").alias("below_half"),
        ratio(F.lit("3.105").cast("decimal(38,8)"), F.lit(3)).cast("decimal(18,2)").alias("half"),
        ratio(F.lit(-3.105), F.lit(3)).cast("decimal(18,2)").alias("negative_half"),
        ratio(wide, F.lit(0)).alias("by_zero"),
    )
    # 1.034999999 would become 1.03500000 and then 1.04 if it were first cut to eight digits.
    assert tuple(got.first()) == (Decimal("1.03"), Decimal("1.04"), Decimal("-1.04"), None)


def test_cancel_counts(spark):
    orders = [
        order(1, is_canceled=True, is_delivered=True, cancellation_reason_id=1),
        order(2, is_canceled=True, cancellation_reason_id=2),
        order(3, is_canceled=True),
        order(4, is_canceled=False, cancellation_reason_id=1),
    ]
    (row,) = mart(spark, orders)
    assert row.canceled_orders_cnt == 3
    # Both timestamps exist; which came first is not asked.
    assert row.canceled_after_delivery_cnt == 1
    assert row.canceled_service_fault_cnt == 1


def test_groups_use_the_delivery_city_and_keep_null_stores_and_dates(spark):
    orders = [
        order(1),
        order(2, delivery_address_id=2),
        order(3, store_id=None),
        order(4, created_at=None),
        order(5, delivery_address_id=None),
    ]
    rows = mart(spark, orders, [line(3, 1, "2")])
    got = {(r.report_date, r.city_name, r.store_id): (r.created_orders_cnt, r.gmv) for r in rows}
    day = date(2024, 1, 5)
    assert got == {
        (day, "Riga", 1): (1, 0),
        (day, "Oslo", 1): (1, 0),
        (day, "Riga", None): (1, 2),
        (None, "Riga", 1): (1, 0),
    }
    assert {(r.year_num, r.month_num, r.day_num) for r in rows} == {(2024, 1, 5), (None,) * 3}


def daily_of(spark, orders, lines, items):
    d = dims_of(spark)
    categories = table(spark, "dim_category", {"category_id": 1, "category_name": "food"})
    return im.items_daily_base(
        table(spark, "fact_order_item", *lines),
        placed_order(table(spark, "fact_order", *orders), d["addresses"]),
        table(spark, "dim_item", *items),
        categories,
        d["cities"],
    )


ITEMS = [
    {"item_id": 1, "item_title": "apple", "category_id": 1},
    {"item_id": 2, "item_title": "bread", "category_id": 1},
    {"item_id": 3, "item_title": "cream", "category_id": 1},
]


def test_daily_base_sums_repeated_lines_and_counts_orders_once(spark):
    lines = [
        line(1, 2, "10", pct=50, canceled=1),
        line(1, 1, "10"),
        line(2, 1, "10", canceled=0),
        line(9, 5, "10"),
        line(1, 1, "10", item=99),
    ]
    (row,) = daily_of(spark, [order(1), order(2), order(3)], lines, ITEMS).collect()
    assert row.item_gmv == Decimal(30)
    assert (row.ordered_units, row.canceled_units) == (4, 1)
    assert (row.orders_with_item_cnt, row.orders_with_item_cancellation_cnt) == (2, 1)
    assert (row.category_name, row.item_title) == ("food", "apple")


def mart_of(daily):
    built = im.items_mart(daily)
    return built.orderBy("report_date", "item_id").collect()


def test_ranks_break_ties_by_item_in_both_directions(spark):
    lines = [line(1, 5, "1", item=1), line(1, 5, "1", item=2), line(1, 7, "1", item=3)]
    rows = mart_of(daily_of(spark, [order(1)], lines, ITEMS))
    assert [r.popularity_rank_day for r in rows] == [2, 3, 1]
    # Not the reverse of the above: the tie is again broken by the smaller id.
    assert [r.anti_popularity_rank_day for r in rows] == [1, 2, 3]
    assert [r.popularity_rank_week for r in rows] == [2, 3, 1]
    assert [r.anti_popularity_rank_month for r in rows] == [1, 2, 3]


def test_weeks_start_on_monday_and_cross_months(spark):
    orders = [
        order(1, created_at="2024-01-31 12:00:00"),
        order(2, created_at="2024-02-01 12:00:00"),
    ]
    lines = [
        line(1, 3, "1", item=1),
        line(1, 2, "1", item=2),
        line(2, 5, "1", item=2),
        line(2, 1, "1", item=1),
    ]
    daily = daily_of(spark, orders, lines, ITEMS)
    assert {r.week_start for r in daily.collect()} == {date(2024, 1, 29)}
    rows = mart_of(daily)
    # Week totals: item 1 has 4 units, item 2 has 7. January alone ranks item 1 first.
    assert [(r.item_id, r.popularity_rank_week) for r in rows] == [(1, 2), (2, 1)] * 2
    assert [r.popularity_rank_month for r in rows] == [1, 2, 2, 1]


def test_rows_without_store_or_date_have_only_a_day_rank(spark):
    orders = [order(1, store_id=None), order(2, created_at=None)]
    lines = [line(1, 1, "1", item=1), line(1, 2, "1", item=2), line(2, 1, "1", item=1)]
    rows = mart_of(daily_of(spark, orders, lines, ITEMS))
    assert len(rows) == 3
    for row in rows:
        assert row.popularity_rank_day is not None and row.anti_popularity_rank_day is not None
        assert row.popularity_rank_week is None and row.anti_popularity_rank_week is None
        assert row.popularity_rank_month is None and row.anti_popularity_rank_month is None


def test_orders_without_items_are_only_in_the_orders_mart(spark):
    assert len(mart(spark, [order(1)])) == 1
    assert daily_of(spark, [order(1)], [], ITEMS).isEmpty()
