"""What is shuffled and stored, and what is left of it."""

import contextlib
import random
import re
import time
from datetime import date
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from orderstar import session
from orderstar.operators import items_mart as im
from orderstar.operators import keys
from orderstar.plans.catalog import QUERIES, layers
from orderstar.sources import samples
from orderstar.sources.files import Warehouse

from .helpers import table


@contextlib.contextmanager
def joins_shuffled(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = blocks.getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def left_of(spark, work):
    before = shuffle_files(spark)
    work()
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def units(spark, count):
    return spark.range(count).select(
        F.lit("g").alias("place"), (F.col("id") % 7).alias("u"), F.col("id").alias("item")
    )


def test_shuffles_of_stored_tables_are_gone(spark, tmp_path):
    spread = units(spark, 500).repartition(5, "item")
    assert left_of(spark, lambda: spread.write.parquet(str(tmp_path / "usual")))
    stored = Warehouse(spark, str(tmp_path / "w"), 1)
    cities = spark.range(50).select("id", F.col("id").cast("string").alias("city_name"))
    cities = cities.withColumnRenamed("id", "city_id").repartition(5, "city_id")
    assert not left_of(spark, lambda: stored.write("dim_city", cities))
    assert stored["dim_city"].count() == 50


def test_ranks_leave_no_shuffle_but_that_of_their_edges(spark):
    sorted_rows = 0

    def work():
        nonlocal sorted_rows
        sorted_rows = keys.two_way_ranks(units(spark, 20_000), ["place"], "u", "item", "down", "up")

    left = left_of(spark, work)
    # The few rows of the edges are collected; what was sorted and measured is gone.
    assert len({name.split("_")[1] for name in left}) <= 1
    assert sorted_rows.count() == 20_000


def test_shuffles_are_freed_inside_the_block_only(spark):
    name = session._FREE_SHUFFLES
    before = spark.conf.get(name, None)
    with pytest.raises(ZeroDivisionError), session.freed_shuffles(spark):
        with session.freed_shuffles(spark):
            pass
        assert spark.conf.get(name) == "true"  # the inner block does not end the outer one
        raise ZeroDivisionError
    assert spark.conf.get(name, None) == before


def test_gathered_rows_stay_so_below_a_sort(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("a"), (F.col("id") * 7 % 100).alias("b"))
    plan = plan_of(session.gathered(frame, "a").orderBy("b"))
    assert plan.index("Exchange rangepartitioning(b") < plan.index("Sort [xxhash64(a")
    both = session.gathered(frame, "a").union(session.gathered(frame, "b"))
    assert both.count() == 200


def test_lines_of_an_order_are_stored_one_after_the_other(spark, sf_dir):
    lines = samples.order_lines(spark, sf_dir).select("order_id")
    for part in lines.rdd.glom().map(lambda rows: [r[0] for r in rows]).collect():
        assert part == sorted(part)


def test_what_lines_share_is_stored_plain(spark, sf_dir):
    t = layers(spark, sf_dir)
    t["fact_order_item"]
    for folder in (t.raw_path(), t.store.path("delivery_raw"), t.store.path("fact_order_item")):
        file = pq.ParquetFile(next(Path(re.sub("^file:", "", folder)).glob("*.parquet"))).metadata
        encodings = {
            file.row_group(0).column(i).path_in_schema: file.row_group(0).column(i).encodings
            for i in range(file.num_columns)
        }
        assert not any("DICTIONARY" in e for e in encodings["order_id"])
        assert any("DICTIONARY" in e for e in encodings["item_id"])


# ------------------------------------------------------------- daily item sales


def test_daily_rows_are_shuffled_once_after_the_fold(spark, sf_dir):
    with joins_shuffled(spark):
        plan = plan_of(QUERIES["items_daily_base"](spark, sf_dir))
    by = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
    by = [re.sub(r"#\d+L?", "", columns) for columns in by]
    assert not [columns for columns in by if "report_date" in columns]
    assert sorted(c for c in by if c.startswith("item_id")) == ["item_id, deal"] * 2  # rows, and titles


def _days(spark, lines):
    """Daily rows of (order, item, quantity); order i is of day i % 20 + 1. Item 1 has two titles."""
    orders = [
        {"order_id": i, "report_date": f"2024-03-{i % 20 + 1:02d}", "city_id": i % 2 + 1, "store_id": i % 3 or None}
        for i in {line[0] for line in lines}
    ]
    items = [{"item_id": i, "item_title": f"t{i}", "category_id": 1} for i in range(300)]
    return im.items_daily_base(
        table(
            spark,
            "fact_order_item",
            *(
                {"order_id": o, "item_id": i, "ordered_quantity": q, "canceled_quantity": 0, "item_price": 2, "item_discount_pct": 0}
                for o, i, q in lines
            ),
        ),
        table(spark, "placed_order", *orders),
        table(spark, "dim_item", *items, {"item_id": 1, "item_title": "other", "category_id": 1}),
        table(spark, "dim_category", {"category_id": 1, "category_name": "food"}),
        table(spark, "dim_city", *({"city_id": c, "city_name": f"c{c}"} for c in (1, 2))),
    )


def test_an_item_of_nearly_all_lines_is_dealt_out(spark, monkeypatch):
    rng = random.Random(4)
    lines = [(o, 1 if rng.random() < 0.9 else rng.choice([None, *range(300)]), rng.randint(1, 5)) for o in range(1500)]
    wanted = {}
    for o, i, q in lines:
        if i is not None:
            key = (date(2024, 3, o % 20 + 1), f"c{o % 2 + 1}", o % 3 or None, i)
            wanted.setdefault(key, []).append(q)
    monkeypatch.setattr(im, "_HOT_SHARE", 0.1)
    daily = _days(spark, lines)
    got = daily.collect()
    for titles, item in ((2, 1), (1, max(key[3] for key in wanted))):
        of = [r for r in got if r.item_id == item]
        assert len({r.item_title for r in of}) == titles
        assert len(of) == titles * sum(key[3] == item for key in wanted)
    seen = {(r.report_date, r.city_name, r.store_id, r.item_id): r for r in got}
    assert set(seen) == set(wanted)
    for key, quantities in wanted.items():
        row = seen[key]
        assert (row.ordered_units, row.orders_with_item_cnt) == (sum(quantities), len(quantities))
        assert row.item_gmv == 2 * sum(quantities)
    assert {r.item_id for r in im.hot_items(table(spark, "fact_order_item", *({"item_id": i} for _, i, _ in lines))).collect()} >= {1}
    with joins_shuffled(spark):
        parts = daily.filter("item_id = 1").select(F.spark_partition_id().alias("p")).distinct()
        off = "spark.sql.adaptive.coalescePartitions.enabled"
        spark.conf.set(off, "false")
        try:
            assert parts.count() > 1
        finally:
            spark.conf.unset(off)


# ------------------------------------------------------------- ranks and the mart


def test_all_periods_are_summed_on_one_shuffle(spark, sf_dir, monkeypatch):
    given = []
    monkeypatch.setattr(im, "two_way_ranks", lambda rows, *names: given.append(rows) or rows)
    daily = layers(spark, sf_dir)["items_daily_base"]
    im.period_ranks(daily, list(im.PERIODS))
    plan = plan_of(given[0])
    assert plan.count("Exchange ") == 1 and "hashpartitioning(city_name" in plan


def test_rows_of_two_titles_have_one_day_rank_and_both_count_for_weeks(spark):
    rows = im.items_mart(_days(spark, [(0, 1, 3), (0, 2, 4), (0, 3, 7)])).collect()
    assert len(rows) == 4
    # Item 1 is there twice with 3 units of the day: third by day, and second with 6 units by week.
    assert {(r.item_id, r.popularity_rank_day) for r in rows} == {(1, 3), (2, 2), (3, 1)}
    rows = im.items_mart(_days(spark, [(1, 1, 3), (1, 2, 4), (1, 3, 7)])).collect()
    assert {(r.item_id, r.popularity_rank_week, r.anti_popularity_rank_week) for r in rows} == {
        (1, 2, 2),
        (2, 3, 1),
        (3, 1, 3),
    }


def test_ranks_gather_their_groups_before_the_sort(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(keys, "checkpointed", lambda df: stored.append(df) or session.checkpointed(df))
    rows = units(spark, 100).withColumn("place", (F.col("item") % 3).cast("string"))
    keys.two_way_ranks(rows, ["place"], "u", "item", "down", "up")
    plan = plan_of(stored[0])
    assert plan.index("Exchange rangepartitioning(_group") < plan.index("Sort [xxhash64(_group")


def test_the_mart_does_not_shuffle_what_follows_from_the_date(spark, sf_dir):
    with joins_shuffled(spark):
        plan = plan_of(QUERIES["items_mart"](spark, sf_dir))
    daily = next(scan for scan in re.findall(r"FileScan parquet \[(.*?)\]", plan) if "item_gmv" in scan)
    read = set(re.findall(r"(\w+)#", daily))
    assert "report_date" in read
    assert not {"year_num", "month_num", "day_num", "week_start", "month_start"} & read
