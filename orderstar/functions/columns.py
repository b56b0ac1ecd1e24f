"""Column expressions shared by the operators. All are Spark built-ins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A line amount has at most six decimals: whole units x price (2) x percent (2) / 100 (2).
AMOUNT = "decimal(24,6)"


def address_part(address: str, part: int) -> Column:
    """The comma-separated part of an address (1-based, '' past the end), without outer spaces."""
    return F.trim(F.split_part(F.col(address), F.lit(","), F.lit(part)))


def discounted_sum(quantity: Column) -> Column:
    """Sum of quantity x price after the percentage discount, exact in decimals.

    The division by 100 is done once on the sum instead of on every line.
    """
    undiscounted_pct = F.lit(100) - F.col("item_discount_pct")
    total = F.sum(quantity * (F.col("item_price") * undiscounted_pct))
    return (total * F.lit("0.01").cast("decimal(3,2)")).cast(AMOUNT)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Decimal quotient, NULL for a zero denominator.

    The numerator is narrowed first: a wide one leaves the quotient only eight digits, and
    rounding it to two afterwards would round twice.
    """
    return numerator.cast(AMOUNT) / F.nullif(denominator, F.lit(0))


def calendar(date: str) -> list[Column]:
    day = F.col(date)
    return [
        day,
        F.year(day).alias("year_num"),
        F.month(day).alias("month_num"),
        F.dayofmonth(day).alias("day_num"),
    ]


def same(left: DataFrame, right: DataFrame, names: list[str], prefix: str = "") -> Column:
    """Join condition that treats NULL keys as equal; right-hand names carry the prefix."""
    return reduce(
        lambda a, b: a & b, (left[n].eqNullSafe(right[f"{prefix}{n}"]) for n in names)
    )
