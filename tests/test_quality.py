from orderstar.operators import quality
from orderstar.schemas import DIMENSIONS, FACTS, FOREIGN_KEYS, NOT_NULL

from .helpers import table


def tables(spark, **rows):
    return {name: table(spark, name, *rows.get(name, ())) for name in [*DIMENSIONS, *FACTS]}


def test_duplicates_are_listed_per_key(spark):
    given = tables(
        spark,
        dim_store=[{"store_id": 1, "store_address_id": 1}, {"store_id": 1, "store_address_id": 2}],
        dim_address=[
            {"address_id": 1, "full_address": "a", "address_type": "store"},
            {"address_id": 2, "full_address": "a", "address_type": "store"},
            {"address_id": 3, "full_address": "a", "address_type": "delivery"},
        ],
        fact_order=[{"order_id": None}, {"order_id": None}],
    )
    got = {tuple(r) for r in quality.pk_duplicates(given).collect()}
    assert got == {("dim_store", "1", 2), ("dim_address", "a|store", 2)}


def test_orphans_count_rows_and_let_null_pass(spark):
    given = tables(
        spark,
        fact_order=[{"order_id": 1, "user_id": None}],
        fact_order_item=[{"order_id": 1}, {"order_id": 2}, {"order_id": 2}, {"order_id": None}],
    )
    got = {r.fk_name: r.orphan_rows for r in quality.fk_orphans(given).collect()}
    assert len(got) == len(FOREIGN_KEYS)
    assert {name: n for name, n in got.items() if n} == {"fact_order_item.order_id": 2}


def test_nulls_are_counted_per_declared_column(spark):
    given = tables(
        spark, dim_item=[{"item_id": 1}, {"item_id": 2, "item_title": "t", "category_id": 1}]
    )
    got = {(r.table_name, r.column_name): r.null_rows for r in quality.null_violations(given).collect()}
    assert len(got) == sum(map(len, NOT_NULL.values()))
    assert {k: n for k, n in got.items() if n} == {
        ("dim_item", "item_title"): 1,
        ("dim_item", "category_id"): 1,
    }


def test_conflicts_count_different_values_null_included(spark):
    lines = table(
        spark,
        "delivery_raw",
        {"user_id": 1, "user_phone": "a", "driver_id": 5},
        {"user_id": 1, "user_phone": None, "driver_id": 5},
        {"user_id": 2, "user_phone": "b", "driver_id": None, "driver_phone": "x"},
        {"user_id": 2, "user_phone": "b", "driver_id": None, "driver_phone": "y"},
    )
    got = [tuple(r) for r in quality.upsert_conflicts(lines).collect()]
    assert got == [("dim_user", "1", 2)]


def test_all_reports_from_one_pass(spark):
    given = tables(
        spark,
        dim_address=[
            {"address_id": 1, "full_address": "a|b", "address_type": "c"},
            {"address_id": 1, "full_address": "a", "address_type": "b|c"},
        ],
        dim_item=[{"item_id": 1, "category_id": 3}, {"item_id": 1, "category_id": 3}],
        fact_order_item=[{"order_id": 1, "item_id": 1}, {"item_id": 7}],
    )
    together = quality.constraint_reports(given)
    apart = (quality.pk_duplicates(given), quality.null_violations(given), quality.fk_orphans(given))
    for one, other in zip(together, apart):
        assert one.columns == other.columns
        assert sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    # Two addresses that only look alike when written side by side are no duplicates.
    assert {tuple(r) for r in together[0].collect()} == {("dim_address", "1", 2), ("dim_item", "1", 2)}


def test_every_table_is_read_once_and_cases_meet_in_one_shuffle(spark, tmp_path):
    given = {}
    for name, frame in tables(spark).items():
        frame.write.parquet(str(tmp_path / name))
        given[name] = spark.read.schema(frame.schema).parquet(str(tmp_path / name))
    for report in (quality.pk_duplicates, quality.fk_orphans, quality.null_violations):
        plan = report(given)._jdf.queryExecution().executedPlan().toString()
        seen = report(given).inputFiles()
        assert len({path.rsplit("/", 2)[1] for path in seen}) == plan.count("FileScan")
        assert "Join" not in plan and plan.count("Exchange hashpartitioning(rule") <= 2
    plan = quality.fk_orphans(given)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2  # the cases, and a row per rule and task
    assert "payment_type_name" not in plan and "full_address" not in plan


def test_a_hot_value_is_counted_before_it_is_shuffled(spark):
    given = tables(spark, fact_order=[{"order_id": 1}])
    lines = spark.range(50_000).selectExpr("1L AS order_id", "2L AS item_id")
    given["fact_order_item"] = lines.withColumn("replaced_by_item_id", lines["item_id"])
    found = {r.fk_name: r.orphan_rows for r in quality.fk_orphans(given).collect()}
    assert found["fact_order_item.item_id"] == 50_000 and found["fact_order_item.order_id"] == 0
