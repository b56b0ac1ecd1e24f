from orderstar.operators import dimensions as dims

from .helpers import spark_content, table


def users(spark, *rows):
    return table(spark, "delivery_raw", *({"user_id": i, "user_phone": p} for i, p in rows))


def test_upsert_overwrites_inserts_and_keeps(spark):
    existing = table(
        spark,
        "dim_user",
        {"user_id": 1, "user_phone": "old1"},
        {"user_id": 2, "user_phone": "old2"},
        {"user_id": 3, "user_phone": "zzz"},
    )
    incoming = users(spark, (2, "new2"), (2, "new2"), (3, None), (4, "new4"), (None, "x"))
    got = dims.dim_user(existing, incoming)
    # Incoming wins even when its value is NULL; untouched ids survive.
    assert sorted(map(tuple, got.collect())) == [(1, "old1"), (2, "new2"), (3, None), (4, "new4")]


def test_first_load_needs_no_existing_table(spark):
    assert sorted(map(tuple, dims.dim_user(None, users(spark, (1, "a"))).collect())) == [(1, "a")]


def test_conflicting_rows_of_one_batch_keep_the_greatest(spark):
    got = dims.dim_user(None, users(spark, (1, "a"), (1, "b"), (1, None), (2, None)))
    assert sorted(map(tuple, got.collect())) == [(1, "b"), (2, None)]


def test_upserting_twice_changes_nothing(spark):
    batch = users(spark, (1, "a"), (2, None))
    once = dims.dim_user(None, batch)
    assert spark_content(dims.dim_user(once, batch)) == spark_content(once)


def test_service_fault_reasons(spark):
    lines = table(
        spark,
        "delivery_raw",
        *(
            {"order_cancellation_reason": r}
            for r in ("Ошибка приложения", "Проблемы с оплатой", "Other", None)
        ),
    )
    got = {r[1]: r[2] for r in dims.dim_cancellation_reason(lines).select(
        "cancellation_reason_id", "cancellation_reason_name", "is_service_fault").collect()}
    assert got == {"Ошибка приложения": True, "Проблемы с оплатой": True, "Other": False}


def places(spark):
    return table(
        spark,
        "delivery_raw",
        {"address_text": " Riga , A st", "store_address": "S1, Riga, B st", "store_id": 1},
        {"address_text": "Riga, A st", "store_address": "S1, Riga, C st", "store_id": 1},
        {"address_text": "\tOslo, X", "store_address": "S2, Nowhere, D st", "store_id": 2},
        {"address_text": "Turku", "store_address": "S3 without city", "store_id": 3},
        {"address_text": None, "store_address": "S4, Turku ,E", "store_id": 4},
    )


def test_cities_come_from_delivery_addresses_without_outer_spaces(spark):
    # Only spaces are trimmed, so the tab stays and sorts first.
    got = sorted(map(tuple, dims.dim_city(places(spark)).collect()))
    assert got == [(1, "\tOslo"), (2, "Riga"), (3, "Turku")]


def test_addresses_keep_their_text_and_deliveries_come_first(spark):
    lines = places(spark)
    got = dims.dim_address(lines, dims.dim_city(lines)).orderBy("address_id").collect()
    assert [(r.address_id, r.city_id, r.full_address, r.address_type) for r in got] == [
        (1, 1, "\tOslo, X", "delivery"),
        (2, 2, " Riga , A st", "delivery"),
        (3, 2, "Riga, A st", "delivery"),
        (4, 3, "Turku", "delivery"),
        (5, 2, "S1, Riga, B st", "store"),
        (6, 2, "S1, Riga, C st", "store"),
        (7, 3, "S4, Turku ,E", "store"),
    ]


def test_empty_city_part_is_a_city_only_if_deliveries_have_it(spark):
    lines = table(
        spark, "delivery_raw", {"address_text": ", street", "store_address": "S", "store_id": 1}
    )
    cities = dims.dim_city(lines)
    assert [r.city_name for r in cities.collect()] == [""]
    assert dims.dim_address(lines, cities).filter("address_type = 'store'").count() == 1


def test_store_of_unknown_city_is_dropped_and_two_addresses_stay(spark):
    lines = places(spark)
    addresses = dims.dim_address(lines, dims.dim_city(lines))
    got = sorted(map(tuple, dims.dim_store(lines, addresses).collect()))
    assert got == [(1, 5), (1, 6), (4, 7)]


def test_items_need_a_category_but_not_a_title(spark):
    lines = table(
        spark,
        "delivery_raw",
        {"item_id": 1, "item_title": "a", "item_category": "x"},
        {"item_id": 1, "item_title": "a", "item_category": "x"},
        {"item_id": 1, "item_title": "b", "item_category": "x"},
        {"item_id": 2, "item_title": None, "item_category": "w"},
        {"item_id": 3, "item_title": "c", "item_category": None},
        {"item_id": None, "item_title": "d", "item_category": "x"},
    )
    got = dims.dim_item(lines, dims.dim_category(lines)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(
        ["(1, 'a', 2)", "(1, 'b', 2)", "(2, None, 1)"]
    )
