from datetime import datetime
from decimal import Decimal

from orderstar.operators import dimensions as dims
from orderstar.operators import facts

from .helpers import table


def orders_of(spark, *lines):
    staged = table(spark, "delivery_raw", *lines)
    addresses = dims.dim_address(staged, dims.dim_city(staged))
    built = facts.fact_order(
        staged, addresses, dims.dim_payment_type(staged), dims.dim_cancellation_reason(staged)
    )
    return {r.order_id: r for r in built.collect()}


def at(hour):
    return f"2024-01-01 {hour:02d}:00:00"


def test_order_folds_its_lines(spark):
    base = {"order_id": 1, "address_text": "A, 1"}
    order = orders_of(
        spark,
        {**base, "user_id": 3, "created_at": at(2), "paid_at": at(3), "delivery_started_at": at(6)},
        {**base, "user_id": 5, "created_at": at(1), "paid_at": at(4), "delivery_started_at": at(5)},
        {**base, "order_discount": 5, "delivered_at": at(7), "payment_type": "card"},
        {**base, "delivery_cost": "9.5", "delivered_at": at(8), "payment_type": "cash"},
    )[1]
    assert order.user_id == 5
    assert order.created_at == datetime(2024, 1, 1, 1)
    assert order.paid_at == datetime(2024, 1, 1, 4)
    assert order.delivery_started_at == datetime(2024, 1, 1, 5)
    assert order.delivered_at == datetime(2024, 1, 1, 8)
    assert (order.order_discount_pct, order.delivery_cost) == (Decimal("5.00"), Decimal("9.50"))
    assert order.payment_type_id == 2
    assert (order.is_delivered, order.is_canceled) == (True, False)
    assert order.cancellation_reason_id is None


def test_missing_amounts_count_as_zero_in_the_maximum(spark):
    base = {"order_id": 1, "address_text": "A, 1"}
    order = orders_of(spark, {**base, "delivery_cost": -5}, base)[1]
    assert order.delivery_cost == 0 and order.order_discount_pct == 0


def test_several_addresses_keep_the_last_key(spark):
    order = orders_of(
        spark,
        {"order_id": 1, "address_text": "B, 1"},
        {"order_id": 1, "address_text": "C, 1"},
        {"order_id": 1, "address_text": "A, 1"},
    )[1]
    assert order.delivery_address_id == 3


def test_lines_without_address_take_no_part(spark):
    got = orders_of(
        spark,
        {"order_id": 1, "address_text": "A, 1", "user_id": 1},
        {"order_id": 1, "address_text": None, "user_id": 9, "canceled_at": at(1)},
        {"order_id": 2, "address_text": None},
        {"order_id": None, "address_text": "A, 1"},
    )
    assert set(got) == {1}
    assert (got[1].user_id, got[1].is_canceled) == (1, False)


def test_repeated_order_lines_stay(spark):
    line = {"order_id": 1, "item_id": 2, "item_quantity": 3, "item_price": "1.50"}
    staged = table(spark, "delivery_raw", line, line, {"order_id": 1}, {"item_id": 2})
    rows = facts.fact_order_item(staged).collect()
    assert [tuple(r) for r in rows] == [(1, 2, 3, 0, Decimal("1.50"), Decimal("0.00"), None)] * 2


def test_assignments_are_distinct_and_end_by_cancel_or_delivery(spark):
    base = {"order_id": 1, "driver_id": 7, "delivery_started_at": at(1)}
    staged = table(
        spark,
        "delivery_raw",
        base,
        base,
        {**base, "canceled_at": at(2)},
        {**base, "canceled_at": at(2), "delivered_at": at(3)},
        {**base, "driver_id": None},
    )
    rows = {tuple(r)[3:] for r in facts.fact_order_driver_assignment(staged).collect()}
    two, three = datetime(2024, 1, 1, 2), datetime(2024, 1, 1, 3)
    assert rows == {(None, None), (two, None), (None, three)}
    assert facts.fact_order_driver_assignment(staged).count() == 3


def test_row_counts(spark):
    counted = facts.row_counts({"a": spark.range(3), "b": spark.range(0)})
    assert {tuple(r) for r in counted.collect()} == {("a", 3), ("b", 0)}
