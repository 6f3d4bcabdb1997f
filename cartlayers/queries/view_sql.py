"""The views of `views.py` in SQL, for checking the queries with another engine."""

from __future__ import annotations

_STAMP = "'%Y-%m-%d %H:%M:%S'"
_REVIEW_ORDER = "event_id + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END"


def _stamp(moment: str) -> str:
    return f"strftime({moment}, {_STAMP})"


def _later(moment: str, days: str) -> str:
    return f"{moment} + to_days(CAST({days} AS INTEGER))"


def _money(name: str) -> str:
    return f"CAST(CAST({name} AS DECIMAL(10,2)) AS VARCHAR)"


VIEWS: dict[str, str] = {
    "v_orders": """
        SELECT *, coalesce(order_delivered_customer_date < order_purchase_timestamp, false)
                  AS flag_data_inconsistente
        FROM (
          SELECT o_orderkey AS order_id, o_custkey AS customer_id,
                 CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
                      ELSE 'processing' END AS order_status,
                 o_orderdate AS order_purchase_timestamp,
                 shipped AS order_delivered_customer_date,
                 CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate + to_days(720) END
                   AS order_estimated_delivery_date
          FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped
                                 FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey)""",
    "v_items_raw": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(10,2)) AS price,
               CAST(l_quantity AS DECIMAL(10,2)) AS freight_value
        FROM lineitem""",
    "v_items": """
        SELECT * FROM v_items_raw
        QUALIFY row_number() OVER (
          PARTITION BY order_id, order_item_id
          ORDER BY product_id, seller_id, shipping_limit_date, price, freight_value) = 1""",
    "v_customers": """
        SELECT c_custkey AS customer_id, n_name AS customer_state, c_mktsegment AS customer_city
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "v_sellers": """
        SELECT s_suppkey AS seller_id, n_name AS seller_state, s_name AS seller_city
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "v_products": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_partkey % 20 <> 0 THEN p_type END AS product_category_name
        FROM part""",
    "v_payments": """
        SELECT o_orderkey AS order_id, CAST(o_totalprice AS DECIMAL(10,2)) AS payment_value,
               CAST(1 + o_orderkey % 10 AS INTEGER) AS payment_installments
        FROM orders""",
    "v_reviews": f"""
        SELECT event_id AS review_id, {_REVIEW_ORDER} AS order_id,
               CAST(1 + user_id % 5 AS INTEGER) AS review_score, ts AS review_creation_date
        FROM events""",
    "v_sales": """
        SELECT o.order_id, customer_id, order_purchase_timestamp, price, freight_value
        FROM v_orders o JOIN v_items i ON i.order_id = o.order_id""",
    "v_delivered": """
        SELECT order_id, strftime(order_purchase_timestamp, '%Y-%m') AS mes,
               date_diff('day', order_purchase_timestamp, order_delivered_customer_date)
                 AS dias_entrega,
               order_delivered_customer_date <= order_estimated_delivery_date AS no_prazo
        FROM v_orders
        WHERE order_status = 'delivered' AND order_delivered_customer_date IS NOT NULL
          AND NOT flag_data_inconsistente""",
    "r_orders": f"""
        WITH base AS (
          SELECT o_orderkey AS k,
                 CASE WHEN o_orderkey % 1009 <> 5 THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
                 CAST(o_custkey AS VARCHAR) AS customer_id,
                 CASE WHEN o_orderstatus = 'F' THEN 'delivered' ELSE 'shipped' END AS order_status,
                 CASE WHEN o_orderkey % 97 = 0 THEN 'abc' WHEN o_orderkey % 89 = 0 THEN ''
                      WHEN o_orderkey % 83 = 0 THEN '2017-13-01'
                      ELSE {_stamp('o_orderdate')} END AS order_purchase_timestamp,
                 CASE WHEN o_orderkey % 13 <> 0 THEN {_stamp(_later('o_orderdate', '1'))} END
                   AS order_approved_at,
                 {_stamp(_later('o_orderdate', '2'))} AS order_delivered_carrier_date,
                 CASE WHEN o_orderkey % 31 <> 0
                      THEN {_stamp(_later('o_orderdate', 'o_orderkey % 45 - 4'))} END
                   AS order_delivered_customer_date,
                 CASE WHEN o_orderkey % 50 <> 0 THEN {_stamp(_later('o_orderdate', '20'))} END
                   AS order_estimated_delivery_date
          FROM orders)
        SELECT * EXCLUDE (k) FROM base
        UNION ALL
        SELECT * EXCLUDE (k) REPLACE ('canceled' AS order_status) FROM base WHERE k % 11 = 0""",
    "r_items": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
               CAST(l_linenumber AS VARCHAR) AS order_item_id,
               CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
               CASE WHEN l_orderkey % 97 = 0 THEN 'no date' ELSE {_stamp('l_shipdate')} END
                 AS shipping_limit_date,
               CASE WHEN l_orderkey % 101 = 0 THEN 'abc' WHEN l_orderkey % 103 = 0 THEN '1.005'
                    WHEN l_orderkey % 107 = 0 THEN '123456789.12'
                    ELSE {_money('l_extendedprice')} END AS price,
               CASE WHEN l_orderkey % 109 = 0 THEN '' ELSE {_money('l_quantity')} END
                 AS freight_value
        FROM lineitem""",
    "r_payments": f"""
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
               CASE WHEN o_orderkey % 61 = 0 THEN 'n/a' WHEN o_orderkey % 67 = 0
                    THEN '123456789.12' ELSE {_money('o_totalprice')} END AS payment_value,
               CASE WHEN o_orderkey % 71 = 0 THEN '' WHEN o_orderkey % 73 = 0 THEN ' 7 '
                    ELSE CAST(1 + o_orderkey % 10 AS VARCHAR) END AS payment_installments
        FROM orders""",
    "r_reviews": f"""
        WITH base AS (
          SELECT event_id AS k, CAST(event_id AS VARCHAR) AS review_id,
                 CAST({_REVIEW_ORDER} AS VARCHAR) AS order_id,
                 CASE WHEN event_id % 41 = 0 THEN '9' WHEN event_id % 43 = 0 THEN 'x'
                      WHEN event_id % 47 = 0 THEN ''
                      ELSE CAST(1 + user_id % 5 AS VARCHAR) END AS review_score,
                 CASE WHEN event_id % 53 = 0 THEN '2017-13-01' ELSE {_stamp('ts')} END
                   AS review_creation_date,
                 {_stamp(_later('ts', '1'))} AS review_answer_timestamp
          FROM events)
        SELECT * EXCLUDE (k) FROM base
        UNION ALL
        SELECT * EXCLUDE (k) REPLACE ('1' AS review_score) FROM base WHERE k % 9 = 0""",
    "r_products": f"""
        WITH base AS (
          SELECT p_partkey AS k, CAST(p_partkey AS VARCHAR) AS product_id,
                 CASE WHEN p_partkey % 20 = 0 THEN NULL WHEN p_partkey % 21 = 0 THEN ' '
                      WHEN p_partkey % 22 = 0 THEN '  ' || upper(p_type) || ' '
                      ELSE p_type END AS product_category_name,
                 CAST(length(p_name) AS VARCHAR) AS product_name_lenght,
                 CASE WHEN p_partkey % 37 = 0 THEN 'many' ELSE CAST(p_size * 10 AS VARCHAR) END
                   AS product_description_lenght,
                 CAST(p_size % 7 AS VARCHAR) AS product_photos_qty,
                 CASE WHEN p_partkey % 41 = 0 THEN 'heavy' ELSE {_money('p_retailprice')} END
                   AS product_weight_g,
                 CAST(p_size AS VARCHAR) || '.5' AS product_length_cm,
                 CAST(p_size % 9 AS VARCHAR) || '.25' AS product_height_cm,
                 CASE WHEN p_partkey % 43 <> 0 THEN CAST(p_size AS VARCHAR) END AS product_width_cm
          FROM part)
        SELECT * EXCLUDE (k) FROM base
        UNION ALL
        SELECT * EXCLUDE (k) REPLACE ('AAA copy' AS product_category_name)
        FROM base WHERE k % 15 = 0""",
    "r_customers": """
        WITH base AS (
          SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS customer_id,
                 c_name AS customer_unique_id,
                 CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
                 ' ' || c_mktsegment || '  ' AS customer_city,
                 lower(n_name) || ' ' AS customer_state
          FROM customer JOIN nation ON n_nationkey = c_nationkey)
        SELECT * EXCLUDE (k) FROM base
        UNION ALL
        SELECT * EXCLUDE (k) REPLACE (chr(9) || 'Z copy' AS customer_city)
        FROM base WHERE k % 10 = 0""",
    "r_sellers": """
        WITH base AS (
          SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS seller_id,
                 CAST(s_nationkey AS VARCHAR) AS seller_zip_code_prefix,
                 ' ' || s_name || ' ' AS seller_city, ' ' || lower(n_name) AS seller_state
          FROM supplier JOIN nation ON n_nationkey = s_nationkey)
        SELECT * EXCLUDE (k) FROM base
        UNION ALL
        SELECT * EXCLUDE (k) REPLACE ('São Copy' AS seller_city) FROM base WHERE k % 4 = 0""",
    "r_geolocation": f"""
        SELECT CAST(c_nationkey AS VARCHAR) AS geolocation_zip_code_prefix,
               CASE WHEN c_custkey % 29 = 0 THEN 'bad' ELSE {_money('c_acctbal')} END
                 AS geolocation_lat,
               {_money('c_acctbal')} AS geolocation_lng,
               CASE WHEN c_custkey % 17 <> 0 THEN c_mktsegment || ' ' END AS geolocation_city,
               ' ' || lower(c_name) AS geolocation_state
        FROM customer""",
    "r_category": """
        SELECT CASE p_partkey % 3 WHEN 0 THEN ' ' || p_type WHEN 1 THEN lower(p_type)
                    ELSE p_type || '  ' END AS product_category_name,
               ' ' || p_type || ' ' || p_brand AS product_category_name_english
        FROM part""",
}

# Views that another view is built on come before it.
_NEEDS = {
    "v_items": ("v_items_raw",),
    "v_sales": ("v_orders", "v_items_raw", "v_items"),
    "v_delivered": ("v_orders",),
}


def with_views(select: str, *names: str, **extra: str) -> str:
    """`select` preceded by the named views and by further named subqueries."""
    ordered: dict[str, str] = {}
    for name in names:
        for needed in (*_NEEDS.get(name, ()), name):
            ordered.setdefault(needed, VIEWS[needed])
    ordered.update(extra)
    parts = ",\n".join(f"{name} AS ({body})" for name, body in ordered.items())
    return f"WITH {parts}\n{select}"


def half_up(total: str, rows: str, decimals: int = 2) -> str:
    """total / rows rounded half up, for a non-negative integer total.

    Integer arithmetic keeps the rounding exact where a division of doubles would not.
    """
    unit = 10**decimals
    return f"CAST({_half_up(f'CAST({total} AS HUGEINT) * {unit}', rows)} AS DOUBLE) / {unit}.0"


def money_mean(cents: str, rows: str) -> str:
    """Mean of money values from their total in cents: six decimals half up, then two."""
    micros = _half_up(f"CAST({cents} AS HUGEINT) * 10000", rows)
    return f"CAST({_half_up(micros, '10000')} AS DOUBLE) / 100.0"


def _half_up(numerator: str, denominator: str) -> str:
    twice = f"(2 * CAST({denominator} AS HUGEINT))"
    return f"((2 * ({numerator}) + CAST({denominator} AS HUGEINT)) // nullif({twice}, 0))"
