"""The whole refresh on random order lines, NULLs everywhere, against the SQL definitions."""

import random

import pytest
from pyspark.sql import functions as F

from oracle import REPORTS, TABLES, statement
from orderstar.operators.items_mart import items_month_rank, items_week_rank
from orderstar.operators.orders_mart import order_driver_stats, order_item_metrics
from orderstar.operators.quality import upsert_conflicts
from orderstar.plans.refresh import refresh

from .helpers import duck_content, spark_content, table

COMPARED = [
    "dim_category",
    "dim_payment_type",
    "dim_cancellation_reason",
    "dim_city",
    "dim_address",
    "dim_store",
    "dim_item",
    "fact_order",
    "fact_order_item",
    "fact_order_driver_assignment",
    "orders_mart",
    "items_daily_base",
    "items_mart",
]
DERIVED = {
    "order_item_metrics": lambda w: order_item_metrics(w["fact_order_item"]),
    "order_driver_stats": lambda w: order_driver_stats(w["fact_order_driver_assignment"]),
    "items_week_rank": lambda w: items_week_rank(w["items_daily_base"]),
    "items_month_rank": lambda w: items_month_rank(w["items_daily_base"]),
    "dq_upsert_conflicts": lambda w: upsert_conflicts(w["delivery_raw"]),
}


def random_lines(seed, count=400):
    """A third of the lines belong to one order, one address and one item."""
    rng = random.Random(seed)

    def maybe(value, missing=0.1):
        return None if rng.random() < missing else value

    def moment():
        return maybe(f"2024-0{rng.randint(1, 3)}-{rng.randint(1, 28):02d} {rng.randint(0, 23):02d}:30:00", 0.2)

    towns = ["Riga", " Riga", "Oslo ", "Ōsaka", ""]
    for _ in range(count):
        hot = rng.random() < 0.33
        quantity = rng.randint(0, 9)
        yield {
            "order_id": 1 if hot else maybe(rng.randint(1, 60)),
            "user_id": maybe(rng.randint(1, 12)),
            "user_phone": maybe(rng.choice(["", "1", "2"]), 0.3),
            "driver_id": maybe(rng.randint(1, 6), 0.3),
            "driver_phone": maybe("d"),
            "address_text": "Riga, hot" if hot else maybe(f"{rng.choice(towns)}, {rng.randint(1, 5)}"),
            "store_id": maybe(rng.randint(1, 3)),
            "store_address": maybe(f"S{rng.randint(1, 3)}, {rng.choice([*towns, 'Nowhere'])}, x"),
            "payment_type": maybe(rng.choice(["card", "cash", "Карта"])),
            "order_cancellation_reason": maybe(
                rng.choice(["Ошибка приложения", "Проблемы с оплатой", "other"]), 0.5
            ),
            "created_at": moment(),
            "paid_at": moment(),
            "delivery_started_at": moment(),
            "delivered_at": maybe(moment(), 0.7),
            "canceled_at": maybe(moment(), 0.7),
            "order_discount": maybe(rng.randint(-5, 30)),
            "delivery_cost": maybe(f"{rng.randint(-999, 9999) / 100:.2f}"),
            "item_id": 1 if hot else maybe(rng.randint(1, 9)),
            "item_title": maybe(rng.choice("ab")),
            "item_category": maybe(rng.choice("xyz")),
            "item_quantity": quantity,
            "item_canceled_quantity": maybe(rng.randint(0, quantity)),
            "item_price": maybe(f"{rng.randint(1, 99999) / 100:.2f}"),
            "item_discount": maybe(f"{rng.randint(0, 9999) / 100:.2f}"),
            "item_replaced_id": maybe(rng.randint(1, 9), 0.8),
        }


@pytest.mark.parametrize("seed", [1, 2])
def test_refresh_equals_sql_on_random_lines(spark, duck, tmp_path, seed):
    raw = str(tmp_path / "raw")
    table(spark, "delivery_raw", *random_lines(seed)).repartition(3).write.parquet(raw)
    built = refresh(spark, raw, str(tmp_path / "warehouse"))
    lines = f"SELECT * FROM read_parquet('{raw}/*.parquet')"

    frames = {name: built[name] for name in COMPARED}
    frames |= {name: query(built) for name, query in DERIVED.items()}
    for name, frame in frames.items():
        wanted = duck_content(duck, statement((TABLES | REPORTS)[name], lines))
        assert spark_content(frame) == wanted, name
        assert wanted, name

    lone = built["dim_user"].groupBy("user_id").agg(F.count("*").alias("n")).filter("n > 1")
    assert lone.isEmpty()
