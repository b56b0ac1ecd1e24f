"""Daily item sales per delivery city and store, with day, week and month popularity ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import calendar, discounted_sum, same
from ..schemas import conform
from ..session import gathered, initial_partitions
from .keys import two_way_ranks

PLACE = ["city_name", "store_id"]

#: An item in more than this share of the lines is dealt over so many partitions, by day and place.
_HOT_SHARE, _DEALS = 0.001, 64


def hot_items(order_items: DataFrame) -> DataFrame:
    """Items in more than ``_HOT_SHARE`` of the lines, ``hot`` being true. At most 1 / ``_HOT_SHARE`` rows.

    Frequent items are counted in bounded memory; a few others may be among them, none is missing.
    """
    found = order_items.stat.freqItems(["item_id"], _HOT_SHARE)
    return found.select(F.explode("item_id_freqItems").alias("item_id"), F.lit(True).alias("hot"))


def items_daily_base(
    order_items: DataFrame,
    placed: DataFrame,
    items: DataFrame,
    categories: DataFrame,
    cities: DataFrame,
) -> DataFrame:
    """Sales per day, delivery city, store and item; ``placed`` are the orders with their place.

    Lines are folded per (order, item) on the partitioning the order join already has; after that
    an order is one row per item and order counts are plain counts. The folded rows are then shuffled
    once, by item, for their sums and for the names; an item found in very many lines is dealt over
    several partitions. Rows are returned by item and place, which keeps stored and shuffled rows small.
    """
    orders = placed.select("order_id", "report_date", "city_id", "store_id")
    per_order = (
        order_items.join(orders, "order_id")
        .groupBy("order_id", "item_id", "report_date", "city_id", "store_id")
        .agg(
            discounted_sum(F.col("ordered_quantity")).alias("gmv"),
            F.sum("ordered_quantity").alias("ordered"),
            F.sum("canceled_quantity").alias("canceled"),
            F.max("canceled_quantity").alias("most_canceled"),
        )
    )
    titles = items.join(categories, "category_id").select(
        "item_id", "item_title", "category_name"
    )
    place = ["report_date", "city_id", "store_id"]
    hot = F.broadcast(hot_items(order_items))
    deal = F.when(
        F.col("hot"), F.pmod(F.xxhash64(*place), F.lit(_DEALS)).cast("int")
    ).otherwise(0)
    sold = per_order.join(hot, "item_id", "left").withColumn("deal", deal).drop("hot", "order_id")
    dealt = gathered(sold, *place).repartition("item_id", "deal")
    per_day = dealt.groupBy("item_id", "deal", *place).agg(
        F.sum("gmv").alias("item_gmv"),
        F.sum("ordered").alias("ordered_units"),
        F.sum("canceled").alias("canceled_units"),
        F.count("*").alias("orders_with_item_cnt"),
        F.count_if(F.col("most_canceled") > 0).alias("orders_with_item_cancellation_cnt"),
    )
    deals = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(_DEALS - 1))).otherwise(F.array(F.lit(0)))
    titles = titles.join(hot, "item_id", "left").select(*titles.columns, F.explode(deals).alias("deal"))
    named = (
        per_day.join(titles, ["item_id", "deal"])
        .drop("deal")
        .join(cities, "city_id")
        .sortWithinPartitions("item_id", "city_id", "store_id", "report_date")
    )
    return conform(_dated(named), "items_daily_base")


def _dated(rows: DataFrame) -> DataFrame:
    """Rows with all that follows from their ``report_date``."""
    return rows.select(
        *calendar("report_date"),
        F.trunc("report_date", "week").alias("week_start"),
        F.trunc("report_date", "month").alias("month_start"),
        *(c for c in rows.columns if c != "report_date"),
    )


#: Column that says in which day, week or month a daily row lies.
PERIODS = {"day": "report_date", "week": "week_start", "month": "month_start"}


def _ranks(period: str) -> list[str]:
    return [f"popularity_rank_{period}", f"anti_popularity_rank_{period}"]


def period_ranks(daily: DataFrame, periods: list[str]) -> DataFrame:
    """Ranks of the items of a store by units over each day, week or month, in one sort for all periods.

    Columns: period (its name), start, place, item_id, units, popular, unpopular.
    """
    # Rows are shuffled once and summed for all periods there, in as many tasks as a shuffle begins with:
    # what AQE would merge here is sorted next.
    needed = [PERIODS[period] for period in periods]
    sold = daily.select(*needed, *PLACE, "item_id", "ordered_units").repartition(
        initial_partitions(daily.sparkSession), "city_name", "item_id"
    )
    # Units of a day are ranked as they are, those of a week or month are summed.
    is_day = F.col("period") == "day"
    starts = F.array(
        *(F.struct(F.lit(p).alias("period"), F.col(PERIODS[p]).alias("start")) for p in periods)
    )
    group = ["period", "start", *PLACE]
    units = (
        sold.select(*PLACE, "item_id", "ordered_units", F.inline(starts))
        .withColumn("own", F.when(is_day, F.col("ordered_units")))
        .groupBy(*group, "item_id", "own")
        .agg(F.sum("ordered_units").alias("total"))
        .select(*group, "item_id", F.when(is_day, F.col("own")).otherwise(F.col("total")).alias("units"))
    )
    return two_way_ranks(units, group, "units", "item_id", "popular", "unpopular")


def _period_rank(daily: DataFrame, period: str) -> DataFrame:
    """One period's ranks under the names of the mart."""
    return period_ranks(daily, [period]).select(
        F.col("start").alias(PERIODS[period]),
        *PLACE,
        "item_id",
        *(F.col(c).cast("bigint").alias(r) for c, r in zip(("popular", "unpopular"), _ranks(period))),
    )


def items_week_rank(daily: DataFrame) -> DataFrame:
    """Ranks of the items of a store over full Monday weeks."""
    return _period_rank(daily, "week")


def items_month_rank(daily: DataFrame) -> DataFrame:
    """Ranks of the items of a store over calendar months."""
    return _period_rank(daily, "month")


def _dealt(ranked: DataFrame, period: str, prefix: str = "") -> tuple[DataFrame, list[Column]]:
    """One period's ranks by city and item, and the two ranks to take from there.

    Items of equal units lie at the same distance in both rankings, so rank and distance are shuffled in fewer
    bytes than two ranks.
    """
    down, distance = f"_{period}_down", f"_{period}_distance"
    keys = {"start": PERIODS[period], **{c: c for c in (*PLACE, "item_id")}, "units": "ordered_units"}
    if period != "day":
        del keys["units"]
    rows = ranked.filter(F.col("period") == period).select(
        *(F.col(c).alias(f"{prefix}{name}") for c, name in keys.items()),
        F.col("popular").alias(down),
        (F.col("unpopular") - F.col("popular")).alias(distance),
    )
    ranks = zip(_ranks(period), (F.col(down), F.col(down) + F.col(distance)))
    dealt = rows.repartition(f"{prefix}city_name", f"{prefix}item_id")
    return dealt, [rank.cast("bigint").alias(name) for name, rank in ranks]


def items_mart(daily: DataFrame) -> DataFrame:
    """Daily rows with their day rank and the ranks of their week and month.

    Ranks are computed on (period, place, item, units) alone, all three in one stored table. They then
    meet the daily rows on one partitioning, by city and item, which daily rows always have. Week and
    month ranks are matched by plain equality: rows without a date or store get none. What follows from the
    date is not shuffled with the daily rows.
    """
    shared = ["city_name", "item_id"]
    ranked = period_ranks(daily, list(PERIODS))
    of_date = [c.name for c in _dated(daily.select("report_date")).schema if c.name != "report_date"]
    rows = daily.drop(*of_date).repartition(*shared)
    day, ranks = _dealt(ranked, "day", "_d_")
    on = same(rows, day, ["report_date", "store_id", "ordered_units"], "_d_")
    for name in shared:
        on = on & (rows[name] == day[f"_d_{name}"])
    joined = _dated(rows.join(day, on, "left").select(*(rows[c] for c in rows.columns), *ranks))
    for period in ("week", "month"):
        other, ranks = _dealt(ranked, period)
        joined = joined.join(other, [PERIODS[period], *PLACE, "item_id"], "left").select(
            *joined.columns, *ranks
        )
    return conform(joined, "items_mart")
