import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderstar.operators.staging import accepted, reject_counts, rejected, stage
from orderstar.schemas import DELIVERY_RAW
from orderstar.sources.files import read_order_lines


def test_absent_columns_become_null_in_declared_order(spark):
    staged = stage(spark.createDataFrame([("x", 7)], "item_title string, ORDER_ID bigint"))
    assert dict(staged.dtypes) == DELIVERY_RAW
    row = staged.first()
    assert (row.order_id, row.item_title) == (7, "x")
    assert all(row[c] is None for c in DELIVERY_RAW if c not in ("order_id", "item_title"))


def test_unknown_column_is_an_error(spark):
    with pytest.raises(ValueError, match="coupon"):
        stage(spark.createDataFrame([(1, "a")], "order_id bigint, coupon string"))


def test_repeated_column_is_an_error(spark):
    raw = spark.range(1).select(F.col("id").alias("order_id"), F.col("id").alias("ORDER_ID"))
    with pytest.raises(ValueError, match="repeat"):
        stage(raw)


@pytest.mark.parametrize(
    "given", ["order_id string", "item_price string", "item_title int", "created_at string"]
)
def test_value_of_another_kind_is_an_error(spark, given):
    with pytest.raises(TypeError, match=given.split()[0]):
        stage(spark.createDataFrame([], given))


def test_numbers_are_rounded_on_assignment(spark):
    raw = spark.sql(
        "SELECT 12.6D AS driver_id, CAST(2.5 AS DECIMAL(4,1)) AS item_quantity,"
        " CAST(2.345 AS DECIMAL(10,3)) AS item_price, CAST(-2.345 AS DECIMAL(10,3)) AS item_discount,"
        " 0.125D AS delivery_cost, CAST(3 AS SMALLINT) AS user_id"
    )
    row = stage(raw).first()
    assert (row.driver_id, row.item_quantity, row.user_id) == (13, 3, 3)
    assert (row.item_price, row.item_discount) == (Decimal("2.35"), Decimal("-2.35"))
    assert row.delivery_cost == Decimal("0.13")


def test_number_out_of_range_is_an_error(spark):
    raw = spark.sql("SELECT CAST(123456789.00 AS DECIMAL(12,2)) AS item_price")
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        stage(raw).collect()


@pytest.mark.parametrize("kind", ["double", "float"])
@pytest.mark.parametrize("value", ["NaN", "Infinity", "-Infinity"])
@pytest.mark.parametrize("name", ["order_discount", "delivery_cost", "item_price", "item_discount"])
def test_money_that_is_no_number_is_an_error(spark, name, value, kind):
    raw = spark.sql(f"SELECT {kind}('{value}') AS {name}")
    with pytest.raises(Exception, match=f"column {name}: a value is not a finite number"):
        stage(raw).collect()
    assert stage(spark.sql(f"SELECT {kind}(NULL) AS {name}")).first()[name] is None


def test_times_lose_no_precision(spark):
    moment = dt.datetime(2024, 3, 1, 23, 59, 59, 123456)
    raw = spark.createDataFrame([(moment, dt.date(2024, 3, 2))], "created_at timestamp_ntz, paid_at date")
    row = stage(raw).first()
    assert (row.created_at, row.paid_at) == (moment, dt.datetime(2024, 3, 2))


def test_reading_needs_files(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_order_lines(spark, str(tmp_path / "absent"))
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        read_order_lines(spark, str(tmp_path))


def test_folder_and_glob_read_the_same(spark, tmp_path):
    folder = str(tmp_path / "raw")
    spark.range(10).select(F.col("id").alias("order_id")).repartition(3).write.parquet(folder)
    assert read_order_lines(spark, folder).count() == 10
    assert read_order_lines(spark, f"{folder}/*.parquet").count() == 10


def reasons(raw):
    return {(r.column_name, r.reason): r.rejected_rows for r in reject_counts(raw).collect()}


def test_every_reason_is_found_and_the_strict_path_still_raises(spark):
    raw = spark.createDataFrame(
        [
            ("12", "2024-01-02 03:04:05", 1.5, True, "a"),
            (" 7.6 ", "2024-01-02", -0.0, None, None),
            ("x", "soon", float("nan"), None, "b"),
            ("99999999999", "", float("-inf"), None, "c"),
            ("1e400", None, 1e9, False, "d"),
            ("NaN", None, None, None, "e"),
            (None, None, None, None, None),
        ],
        "item_quantity string, paid_at string, item_price double, store_id boolean, item_title string",
    )
    assert reasons(raw) == {
        ("item_quantity", "not a number"): 1,
        ("item_quantity", "out of range"): 1,
        ("item_quantity", "not finite"): 2,
        ("paid_at", "not a time"): 2,
        ("item_price", "not finite"): 2,
        ("item_price", "out of range"): 1,
        ("store_id", "wrong kind"): 2,
    }
    kept = accepted(raw)
    assert dict(kept.dtypes) == DELIVERY_RAW
    assert [(r.item_quantity, r.paid_at, r.item_price) for r in kept.collect()] == [
        (8, dt.datetime(2024, 1, 2), Decimal("0.00")),
        (None, None, None),
    ]
    bad = rejected(raw).collect()
    assert len(bad) == 5 and {r.item_title for r in bad} == {"a", "b", "c", "d", "e"}
    assert bad[0].item_quantity == 12 and bad[0].rejects[0].column_name == "store_id"
    with pytest.raises(TypeError, match="cannot be stored"):
        stage(raw)
    with pytest.raises(TypeError, match="item_quantity"):
        stage(raw.select("item_quantity"))


def test_lines_the_strict_path_takes_are_accepted_as_it_stages_them(spark):
    raw = spark.sql(
        "SELECT 12.6D AS driver_id, CAST(2.5 AS DECIMAL(4,1)) AS item_quantity, 7 AS user_id,"
        " CAST(2.345 AS DECIMAL(10,3)) AS item_price, 0.125D AS delivery_cost, NULL AS item_id,"
        " TIMESTAMP'2024-05-06 07:08:09' AS created_at, DATE'2024-05-06' AS paid_at, 'x' AS ITEM_TITLE"
    )
    assert accepted(raw).collect() == stage(raw).collect()
    assert reasons(raw) == {} and rejected(raw).isEmpty()
    with pytest.raises(ValueError, match="coupon"):
        rejected(spark.createDataFrame([(1,)], "coupon int"))


def test_rejects_shuffle_no_lines(spark):
    raw = spark.range(50_000).selectExpr("'x' AS item_quantity", "id AS order_id")
    counts = reject_counts(raw)
    assert reasons(raw) == {("item_quantity", "not a number"): 50_000}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan
