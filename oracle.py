"""SQL counterparts of the queries, for DuckDB over the same test tables.

Each statement is self-contained: it starts from the base tables, derives the order lines with the
mapping of FIXTURES.md and states the wanted result directly (distinct counts over the joined
rows, keys by one global numbering), independent of how the Spark operators compute it.
"""

from __future__ import annotations

import re

_LINES = """
SELECT
  k AS order_id,
  u AS user_id,
  CASE WHEN u % 9 = 0 THEN NULL ELSE '+7' || lpad(CAST(u AS VARCHAR(20)), 10, '0') END AS user_phone,
  CASE WHEN k % 23 = 0 THEN NULL ELSE drv END AS driver_id,
  CASE WHEN k % 23 = 0 THEN NULL ELSE '+8' || lpad(CAST(drv AS VARCHAR(20)), 10, '0') END AS driver_phone,
  CASE WHEN k % 17 = 0 AND l_linenumber % 2 = 0 THEN 'MIDDLE EAST, Alt ' || CAST(u AS VARCHAR(20))
       ELSE CASE WHEN u % 5 = 0 THEN ' ' ELSE '' END || r_name || CASE WHEN u % 7 = 0 THEN ' ' ELSE '' END
            || ', Street ' || CAST(u AS VARCHAR(20)) END AS address_text,
  k % 4 + 1 AS store_id,
  'Store ' || CAST(k % 4 + 1 AS VARCHAR(20)) || ', '
    || CASE k % 4 WHEN 0 THEN 'ASIA' WHEN 1 THEN 'EUROPE' WHEN 2 THEN 'AFRICA' ELSE 'AMERICA' END
    || ', Main st' AS store_address,
  CASE WHEN k % 13 = 0 THEN NULL ELSE o_orderpriority END AS payment_type,
  CASE WHEN is_cxl THEN CASE k % 5 WHEN 0 THEN 'Ошибка приложения' WHEN 1 THEN 'Проблемы с оплатой'
       WHEN 2 THEN 'Customer changed mind' WHEN 3 THEN 'Out of stock' ELSE NULL END
       ELSE NULL END AS order_cancellation_reason,
  t0 AS created_at,
  t0 + INTERVAL '2' MINUTE AS paid_at,
  CASE WHEN k % 23 = 0 THEN NULL WHEN is_swap THEN t0 + INTERVAL '35' MINUTE
       ELSE t0 + INTERVAL '20' MINUTE END AS delivery_started_at,
  CASE WHEN is_dlv THEN t0 + INTERVAL '60' MINUTE ELSE NULL END AS delivered_at,
  CASE WHEN is_cxl THEN t0 + INTERVAL '90' MINUTE ELSE NULL END AS canceled_at,
  CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(k % 4 * 5 AS DECIMAL(10,2)) END AS order_discount,
  CASE WHEN k % 19 = 0 THEN NULL ELSE CAST(99 + k % 50 AS DECIMAL(10,2)) END AS delivery_cost,
  l_partkey AS item_id,
  p_name AS item_title,
  p_type AS item_category,
  CAST(l_quantity AS INT) AS item_quantity,
  CASE WHEN o_orderstatus = 'P' THEN CAST(l_quantity AS INT) WHEN l_returnflag = 'R' THEN 1
       ELSE NULL END AS item_canceled_quantity,
  CAST(p_retailprice AS DECIMAL(10,2)) AS item_price,
  CASE WHEN l_discount = 0 THEN NULL ELSE CAST(l_discount * 100 AS DECIMAL(10,2)) END AS item_discount,
  CASE WHEN l_returnflag = 'A' AND l_linenumber % 2 = 0 THEN l_partkey + 1 ELSE NULL END AS item_replaced_id
FROM (
  SELECT o_orderkey AS k, o_custkey AS u, o_orderstatus, o_orderpriority, r_name,
         l_partkey, l_linenumber, l_quantity, l_discount, l_returnflag, p_name, p_type, p_retailprice,
         (o_orderstatus = 'P' OR (o_orderstatus = 'O' AND o_orderkey % 11 = 0)) AS is_cxl,
         o_orderstatus IN ('F', 'O') AS is_dlv,
         (o_orderkey % 10 = 3 AND l_linenumber % 2 = 0) AS is_swap,
         (o_orderkey % 97) + 1 + CASE WHEN o_orderkey % 10 = 3 AND l_linenumber % 2 = 0 THEN 1 ELSE 0 END AS drv,
         TIMESTAMP '2024-01-01 00:00:00' + (o_orderkey * 7919 % 129600) * INTERVAL '1' MINUTE AS t0
  FROM lineitem
  JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
  JOIN region ON r_regionkey = n_regionkey
  JOIN part ON p_partkey = l_partkey
) AS src
"""

_DIRTY_LINES = """
SELECT
  CASE WHEN order_id % 997 = 2 THEN NULL ELSE order_id END AS order_id,
  user_id,
  CASE WHEN user_id % 50 = 7 AND order_id % 2 = 0 THEN '+70000000000' ELSE user_phone END AS user_phone,
  driver_id,
  CASE WHEN driver_id % 40 = 7 AND order_id % 2 = 0 THEN '+80000000000' ELSE driver_phone END AS driver_phone,
  CASE WHEN order_id % 499 = 1 THEN NULL ELSE address_text END AS address_text,
  CASE WHEN order_id % 211 = 0 THEN 5 ELSE store_id END AS store_id,
  CASE WHEN order_id % 211 = 0 THEN 'Store 5, NOWHERE, Main st'
       WHEN order_id % 300 = 1 THEN 'Store 2b, EUROPE, Alt st' ELSE store_address END AS store_address,
  payment_type, order_cancellation_reason,
  created_at, paid_at, delivery_started_at, delivered_at, canceled_at,
  order_discount, delivery_cost,
  item_id,
  CASE WHEN item_id % 90 = 9 THEN NULL
       WHEN item_id % 80 = 5 AND order_id % 2 = 0 THEN item_title || ' v2' ELSE item_title END AS item_title,
  CASE WHEN item_id % 100 = 3 THEN NULL ELSE item_category END AS item_category,
  item_quantity, item_canceled_quantity, item_price, item_discount, item_replaced_id
FROM clean_lines
"""


def _numbered(key: str, name: str, values: str, extra: str = "") -> str:
    return (
        f"SELECT row_number() OVER (ORDER BY {name}) AS {key}, {name}{extra} "
        f"FROM (SELECT DISTINCT {values} AS {name} FROM lines) AS v WHERE {name} IS NOT NULL"
    )


def _merged(key: str, attribute: str, existing: str) -> str:
    return f"""
SELECT coalesce(n.{key}, e.{key}) AS {key},
       CASE WHEN n.{key} IS NULL THEN e.{attribute} ELSE n.{attribute} END AS {attribute}
FROM {existing} AS e
FULL JOIN (SELECT {key}, max({attribute}) AS {attribute} FROM lines
           WHERE {key} IS NOT NULL GROUP BY {key}) AS n ON n.{key} = e.{key}
"""


def _net(quantity: str) -> str:
    return (
        f"CAST(SUM(CAST({quantity} AS DECIMAL(10,0)) * item_price * (100 - item_discount_pct))"
        " * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(24,6))"
    )


def _ratio(numerator: str, denominator: str, digits: int) -> str:
    """Half-up quotient in integers, since DuckDB divides decimals as doubles."""
    step = 10 ** (6 - digits)
    unit = {2: "CAST(0.01 AS DECIMAL(3,2))", 4: "CAST(0.0001 AS DECIMAL(5,4))"}[digits]
    parts = f"NULLIF({denominator}, 0) * {step}"
    whole = f"(2 * CAST({numerator} * 1000000 AS HUGEINT) + {parts}) // (2 * {parts})"
    return f"CAST(CAST({whole} AS DECIMAL(18,0)) * {unit} AS DECIMAL(18,{digits}))"


_UNITS_FIRST = "{units} {way}, item_id ASC NULLS LAST"


def _rank(keys: str, units: str, ascending: bool) -> str:
    way = "ASC NULLS LAST" if ascending else "DESC NULLS FIRST"
    return (
        f"CAST(DENSE_RANK() OVER (PARTITION BY {keys} "
        f"ORDER BY {_UNITS_FIRST.format(units=units, way=way)}) AS BIGINT)"
    )


def _period_rank(start: str, suffix: str) -> str:
    keys = f"{start}, city_name, store_id"
    return f"""
SELECT {keys}, item_id,
       {_rank(keys, 'units', False)} AS popularity_rank_{suffix},
       {_rank(keys, 'units', True)} AS anti_popularity_rank_{suffix}
FROM (SELECT {keys}, item_id, SUM(ordered_units) AS units
      FROM items_daily_base GROUP BY {keys}, item_id) AS totals
"""


def _once(condition: str) -> str:
    return f"COUNT(DISTINCT CASE WHEN {condition} THEN order_id END)"


TABLES = {
    "clean_lines": _LINES,
    "lines": "SELECT * FROM clean_lines",
    "existing_user": "SELECT c_custkey * 2 AS user_id, "
    "'old-' || CAST(c_custkey AS VARCHAR(20)) AS user_phone FROM customer",
    "existing_driver": "SELECT s_suppkey * 20 + 1 AS driver_id, "
    "'old-' || CAST(s_suppkey AS VARCHAR(20)) AS driver_phone FROM supplier",
    "dim_user": _merged("user_id", "user_phone", "existing_user"),
    "dim_driver": _merged("driver_id", "driver_phone", "existing_driver"),
    "dim_category": _numbered("category_id", "category_name", "item_category"),
    "dim_payment_type": _numbered("payment_type_id", "payment_type_name", "payment_type"),
    "dim_cancellation_reason": _numbered(
        "cancellation_reason_id",
        "cancellation_reason_name",
        "order_cancellation_reason",
        ", cancellation_reason_name IN ('Ошибка приложения', 'Проблемы с оплатой') AS is_service_fault",
    ),
    "dim_city": _numbered("city_id", "city_name", "trim(split_part(address_text, ',', 1))"),
    "dim_address": """
SELECT row_number() OVER (ORDER BY address_type, full_address) AS address_id,
       city_id, full_address, address_type
FROM (SELECT DISTINCT address_text AS full_address, 'delivery' AS address_type,
             trim(split_part(address_text, ',', 1)) AS town FROM lines
      UNION ALL
      SELECT DISTINCT store_address, 'store', trim(split_part(store_address, ',', 2)) FROM lines
     ) AS places
JOIN dim_city ON city_name = town
""",
    "dim_store": """
SELECT DISTINCT store_id, address_id AS store_address_id
FROM dim_address JOIN lines ON store_address = full_address
WHERE address_type = 'store' AND store_id IS NOT NULL
""",
    "dim_item": """
SELECT DISTINCT item_id, item_title, category_id
FROM dim_category JOIN lines ON item_category = category_name
WHERE item_id IS NOT NULL
""",
    "fact_order": """
SELECT order_id, max(user_id) AS user_id, max(address_id) AS delivery_address_id,
       max(store_id) AS store_id, max(payment_type_id) AS payment_type_id,
       max(cancellation_reason_id) AS cancellation_reason_id,
       min(created_at) AS created_at, max(paid_at) AS paid_at,
       min(delivery_started_at) AS delivery_started_at,
       max(delivered_at) AS delivered_at, max(canceled_at) AS canceled_at,
       CAST(max(coalesce(order_discount, 0)) AS DECIMAL(10,2)) AS order_discount_pct,
       CAST(max(coalesce(delivery_cost, 0)) AS DECIMAL(10,2)) AS delivery_cost,
       count(canceled_at) > 0 AS is_canceled, count(delivered_at) > 0 AS is_delivered
FROM (SELECT * FROM dim_address WHERE address_type = 'delivery') AS home
JOIN lines ON address_text = full_address
LEFT JOIN dim_payment_type ON payment_type_name = payment_type
LEFT JOIN dim_cancellation_reason ON cancellation_reason_name = order_cancellation_reason
WHERE order_id IS NOT NULL
GROUP BY order_id
""",
    "fact_order_item": """
SELECT order_id, item_id, coalesce(item_quantity, 0) AS ordered_quantity,
       coalesce(item_canceled_quantity, 0) AS canceled_quantity,
       CAST(coalesce(item_price, 0) AS DECIMAL(10,2)) AS item_price,
       CAST(coalesce(item_discount, 0) AS DECIMAL(10,2)) AS item_discount_pct,
       item_replaced_id AS replaced_by_item_id
FROM lines WHERE order_id IS NOT NULL AND item_id IS NOT NULL
""",
    "fact_order_driver_assignment": """
SELECT order_id, driver_id, delivery_started_at AS assigned_at,
       CASE WHEN delivered_at IS NULL THEN canceled_at END AS unassigned_at,
       delivered_at AS delivered_at_by_driver
FROM lines WHERE order_id IS NOT NULL AND driver_id IS NOT NULL
GROUP BY ALL
""",
    "order_item_metrics": f"""
SELECT order_id, {_net('ordered_quantity')} AS gmv,
       {_net('(ordered_quantity - canceled_quantity)')} AS revenue
FROM fact_order_item GROUP BY order_id
""",
    "order_driver_stats": """
SELECT order_id, COUNT(DISTINCT driver_id) AS driver_cnt
FROM fact_order_driver_assignment GROUP BY order_id
""",
    "order_rows": """
SELECT CAST(o.created_at AS DATE) AS report_date, city_name, o.store_id, o.order_id, o.user_id,
       a.driver_id, s.driver_cnt, gmv, revenue, delivery_cost, is_canceled, is_delivered,
       delivered_at, is_service_fault
FROM fact_order AS o
JOIN dim_address AS d ON d.address_id = o.delivery_address_id
JOIN dim_city AS t ON t.city_id = d.city_id
LEFT JOIN dim_cancellation_reason AS r ON r.cancellation_reason_id = o.cancellation_reason_id
LEFT JOIN order_item_metrics AS m ON m.order_id = o.order_id
LEFT JOIN order_driver_stats AS s ON s.order_id = o.order_id
LEFT JOIN fact_order_driver_assignment AS a ON a.order_id = o.order_id
""",
    "order_days": f"""
SELECT report_date, city_name, store_id,
       coalesce(SUM(gmv), 0) AS gmv, coalesce(SUM(revenue), 0) AS revenue,
       coalesce(SUM(delivery_cost), 0) AS cost,
       COUNT(DISTINCT order_id) AS created_orders_cnt,
       {_once('is_delivered')} AS delivered_orders_cnt,
       {_once('is_canceled')} AS canceled_orders_cnt,
       {_once('is_canceled AND delivered_at IS NOT NULL')} AS canceled_after_delivery_cnt,
       {_once('is_canceled AND is_service_fault')} AS canceled_service_fault_cnt,
       COUNT(DISTINCT user_id) AS customers_cnt,
       {_once('driver_cnt > 1')} AS courier_change_orders_cnt,
       COUNT(DISTINCT driver_id) AS active_drivers_cnt
FROM order_rows GROUP BY report_date, city_name, store_id
""",
    "orders_mart": f"""
SELECT report_date, CAST(year(report_date) AS INTEGER) AS year_num,
       CAST(month(report_date) AS INTEGER) AS month_num,
       CAST(day(report_date) AS INTEGER) AS day_num, city_name, store_id,
       CAST(gmv AS DECIMAL(18,2)) AS gmv, CAST(revenue AS DECIMAL(18,2)) AS revenue,
       CAST(revenue - cost AS DECIMAL(18,2)) AS profit,
       created_orders_cnt, delivered_orders_cnt, canceled_orders_cnt,
       canceled_after_delivery_cnt, canceled_service_fault_cnt, customers_cnt,
       {_ratio('revenue', 'delivered_orders_cnt', 2)} AS avg_check,
       {_ratio('created_orders_cnt', 'customers_cnt', 4)} AS orders_per_customer,
       {_ratio('revenue', 'customers_cnt', 2)} AS revenue_per_customer,
       courier_change_orders_cnt, active_drivers_cnt
FROM order_days
""",
    "items_daily_base": f"""
SELECT CAST(created_at AS DATE) AS report_date,
       CAST(year(created_at) AS INTEGER) AS year_num,
       CAST(month(created_at) AS INTEGER) AS month_num,
       CAST(day(created_at) AS INTEGER) AS day_num,
       CAST(date_trunc('week', created_at) AS DATE) AS week_start,
       CAST(date_trunc('month', created_at) AS DATE) AS month_start,
       city_name, store_id, category_name, l.item_id, item_title,
       {_net('ordered_quantity')} AS item_gmv,
       CAST(SUM(ordered_quantity) AS BIGINT) AS ordered_units,
       CAST(SUM(canceled_quantity) AS BIGINT) AS canceled_units,
       COUNT(DISTINCT order_id) AS orders_with_item_cnt,
       {_once('canceled_quantity > 0')} AS orders_with_item_cancellation_cnt
FROM fact_order_item AS l
JOIN fact_order AS o USING (order_id)
JOIN dim_address AS d ON d.address_id = o.delivery_address_id
JOIN dim_city AS t ON t.city_id = d.city_id
JOIN dim_item AS i ON i.item_id = l.item_id
JOIN dim_category AS g ON g.category_id = i.category_id
GROUP BY ALL
""",
    "items_week_rank": _period_rank("week_start", "week"),
    "items_month_rank": _period_rank("month_start", "month"),
    "items_mart": f"""
SELECT report_date, year_num, month_num, day_num, city_name, store_id, category_name,
       item_id, item_title, CAST(item_gmv AS DECIMAL(18,2)) AS item_gmv,
       ordered_units, canceled_units, orders_with_item_cnt, orders_with_item_cancellation_cnt,
       {_rank('report_date, city_name, store_id', 'ordered_units', False)} AS popularity_rank_day,
       popularity_rank_week, popularity_rank_month,
       {_rank('report_date, city_name, store_id', 'ordered_units', True)} AS anti_popularity_rank_day,
       anti_popularity_rank_week, anti_popularity_rank_month
FROM items_daily_base
LEFT JOIN items_week_rank USING (week_start, city_name, store_id, item_id)
LEFT JOIN items_month_rank USING (month_start, city_name, store_id, item_id)
""",
}

# Key columns that must not repeat, and the columns that must not be NULL, per table.
_UNIQUE = [
    ("dim_user", "user_id"),
    ("dim_driver", "driver_id"),
    ("dim_category", "category_id"),
    ("dim_payment_type", "payment_type_id"),
    ("dim_cancellation_reason", "cancellation_reason_id"),
    ("dim_city", "city_id"),
    ("dim_address", "address_id"),
    ("dim_store", "store_id"),
    ("dim_item", "item_id"),
    ("fact_order", "order_id"),
    ("dim_category", "category_name"),
    ("dim_payment_type", "payment_type_name"),
    ("dim_cancellation_reason", "cancellation_reason_name"),
    ("dim_city", "city_name"),
    ("dim_address", "full_address || '|' || address_type"),
]
_PARENTS = [
    ("dim_address", "city_id", "dim_city", "city_id"),
    ("dim_store", "store_address_id", "dim_address", "address_id"),
    ("dim_item", "category_id", "dim_category", "category_id"),
    ("fact_order", "user_id", "dim_user", "user_id"),
    ("fact_order", "delivery_address_id", "dim_address", "address_id"),
    ("fact_order", "store_id", "dim_store", "store_id"),
    ("fact_order", "payment_type_id", "dim_payment_type", "payment_type_id"),
    ("fact_order", "cancellation_reason_id", "dim_cancellation_reason", "cancellation_reason_id"),
    ("fact_order_item", "order_id", "fact_order", "order_id"),
    ("fact_order_item", "item_id", "dim_item", "item_id"),
    ("fact_order_driver_assignment", "order_id", "fact_order", "order_id"),
    ("fact_order_driver_assignment", "driver_id", "dim_driver", "driver_id"),
]
_FILLED = [
    ("dim_category", "category_name"),
    ("dim_payment_type", "payment_type_name"),
    ("dim_cancellation_reason", "cancellation_reason_name"),
    ("dim_cancellation_reason", "is_service_fault"),
    ("dim_city", "city_name"),
    ("dim_address", "city_id"),
    ("dim_address", "full_address"),
    ("dim_address", "address_type"),
    ("dim_store", "store_address_id"),
    ("dim_item", "item_title"),
    ("dim_item", "category_id"),
    ("fact_order_item", "order_id"),
    ("fact_order_item", "item_id"),
    ("fact_order_driver_assignment", "order_id"),
    ("fact_order_driver_assignment", "driver_id"),
]


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


REPORTS = {
    "dq_pk_duplicates": _union(
        f"SELECT '{table}' AS table_name, CAST({key} AS VARCHAR) AS key_value, "
        f"COUNT(*) AS dup_cnt FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} "
        "HAVING COUNT(*) > 1"
        for table, key in _UNIQUE
    ),
    "dq_fk_orphans": _union(
        f"SELECT '{child}.{column}' AS fk_name, COUNT(*) AS orphan_rows FROM {child} AS c "
        f"WHERE {column} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {parent} AS p WHERE p.{key} = c.{column})"
        for child, column, parent, key in _PARENTS
    ),
    "dq_not_null": _union(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, "
        f"COUNT(*) - COUNT({column}) AS null_rows FROM {table}"
        for table, column in _FILLED
    ),
    "dq_upsert_conflicts": _union(
        f"SELECT '{table}' AS table_name, CAST({key} AS VARCHAR) AS key_value, "
        f"COUNT(*) AS variant_cnt FROM (SELECT DISTINCT {key}, {value} FROM lines) AS variants "
        f"WHERE {key} IS NOT NULL GROUP BY {key} HAVING COUNT(*) > 1"
        for table, key, value in [
            ("dim_user", "user_id", "user_phone"),
            ("dim_driver", "driver_id", "driver_phone"),
        ]
    ),
}


def statement(body: str, lines: str = TABLES["lines"]) -> str:
    """Put the tables a statement names, and the ones those name, in front of it.

    ``lines`` is the query for the order lines everything starts from.
    """
    tables = {**TABLES, "lines": lines}
    needed: list[str] = []

    def add(sql: str) -> None:
        for name in tables:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN) {name}\b", sql):
                add(tables[name])
                if name not in needed:
                    needed.append(name)

    add(body)
    # Materialized, since some tables are read several times.
    parts = ",\n".join(f"{name} AS MATERIALIZED ({tables[name].strip()})" for name in needed)
    return f"WITH {parts}\n{body.strip()}"


# Which lines of a writer without types cannot be staged, per column and reason.
_REJECTS = [
    ("user_id", "out of range", "user_id % 113 = 5"),
    ("created_at", "not a time", "order_id % 107 = 3"),
    ("order_discount", "not a number", "order_id % 109 = 4"),
    ("item_quantity", "not a number", "order_id % 101 = 1"),
    ("item_quantity", "out of range", "order_id % 101 <> 1 AND order_id % 103 = 2"),
    ("item_price", "not finite", "item_id % 97 = 1"),
    ("item_price", "out of range", "item_id % 97 <> 1 AND item_id % 89 = 2"),
    ("item_replaced_id", "wrong kind", "item_replaced_id IS NOT NULL"),
]

ORACLES = {
    "stage_delivery_raw": statement(TABLES["lines"]),
    "dim_user_upsert": statement(TABLES["dim_user"]),
    "dim_driver_upsert": statement(TABLES["dim_driver"]),
    **{
        name: statement(TABLES[name])
        for name in (
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
            "order_item_metrics",
            "order_driver_stats",
            "orders_mart",
            "items_daily_base",
            "items_week_rank",
            "items_month_rank",
            "items_mart",
        )
    },
    "fact_row_counts": statement(
        _union(
            f"SELECT '{name}' AS table_name, COUNT(*) AS row_cnt FROM {name}"
            for name in ("fact_order", "fact_order_item", "fact_order_driver_assignment")
        )
    ),
    **{name: statement(sql, _DIRTY_LINES) for name, sql in REPORTS.items()},
    "dq_staging_rejects": statement(
        _union(
            f"SELECT '{column}' AS column_name, '{reason}' AS reason, COUNT(*) AS rejected_rows "
            f"FROM lines WHERE {condition} HAVING COUNT(*) > 0"
            for column, reason, condition in _REJECTS
        )
    ),
}
