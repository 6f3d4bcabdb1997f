"""Joins, windows and the business tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlayers.functions.dates import month_label
from cartlayers.operators.references import orphans, with_matches
from cartlayers.plans import gold as g
from cartlayers.queries.entry import Query
from cartlayers.queries.view_sql import half_up, money_mean, with_views
from cartlayers.queries.views import Views

# Near the median number of orders per seller, so that the threshold removes some of them.
RAISED_MIN_ORDERS = 458

MONTHLY_SQL = """
    SELECT strftime(order_purchase_timestamp, '%Y-%m') AS mes,
           CAST(sum(CAST(price * 100 AS BIGINT)) AS HUGEINT) AS cents,
           sum(freight_value) AS freight, count(DISTINCT order_id) AS orders
    FROM v_sales GROUP BY 1"""

MONTHLY_LAG_SQL = f"""
    SELECT *, lag(cents) OVER (ORDER BY mes NULLS FIRST) AS previous FROM ({MONTHLY_SQL})"""

_CHANGE = (
    "sign(cents - previous) * CAST((2 * abs(cents - previous) * 10000 + previous) // "
    "nullif(2 * previous, 0) AS DOUBLE) / 100.0"
)

REVENUE_SQL = f"""
    SELECT mes, CAST(cents AS DOUBLE) / 100 AS receita_produtos,
           CAST(freight AS DOUBLE) AS receita_frete, orders AS qtd_pedidos,
           {_CHANGE} AS variacao_pct
    FROM ({MONTHLY_LAG_SQL})"""

STATE_SQL = f"""
    SELECT customer_state AS estado, CAST(sum(price) AS DOUBLE) AS receita_total,
           count(DISTINCT order_id) AS qtd_pedidos,
           {money_mean('sum(CAST(price * 100 AS BIGINT))', 'count(price)')} AS ticket_medio
    FROM v_sales JOIN v_customers USING (customer_id) GROUP BY 1"""

DELIVERY_SQL = f"""
    SELECT *, round(100 - pct_entregas_no_prazo, 2) AS pct_entregas_atrasadas FROM (
      SELECT mes, {half_up('sum(dias_entrega)', 'count(dias_entrega)', 1)}
               AS tempo_medio_entrega_dias,
             {half_up('(100 * count(*) FILTER (WHERE no_prazo))', 'count(no_prazo)')}
               AS pct_entregas_no_prazo,
             count(DISTINCT order_id) AS qtd_pedidos_entregues
      FROM v_delivered GROUP BY mes)"""

SATISFACTION_SQL = f"""
    SELECT CASE WHEN no_prazo THEN 'no_prazo' ELSE 'atrasado' END AS status_entrega,
           {half_up('sum(review_score)', 'count(review_score)')} AS nota_media,
           count(review_id) AS qtd_avaliacoes
    FROM v_delivered JOIN v_reviews USING (order_id) GROUP BY 1"""


def ranking_sql(min_orders: int) -> str:
    return f"""
    SELECT seller_id, seller_state, CAST(sum(price) AS DOUBLE) AS receita_total,
           count(DISTINCT i.order_id) AS qtd_pedidos,
           {half_up('sum(review_score)', 'count(review_score)')} AS nota_media
    FROM v_items i JOIN v_orders o ON o.order_id = i.order_id JOIN v_sellers USING (seller_id)
    LEFT JOIN v_reviews r ON r.order_id = i.order_id
    GROUP BY seller_id, seller_state HAVING count(DISTINCT i.order_id) >= {min_orders}"""


RANKING_VIEWS = ("v_items", "v_orders", "v_sellers", "v_reviews")

# Order grain: scores are whole numbers and an order has at most two reviews in these tables, so
# twice the mean of an order is a whole number and the rounding stays exact.
ORDER_GRAIN_SQL = f"""
    SELECT seller_id, seller_state, CAST(sum(price) AS DOUBLE) AS receita_total,
           count(DISTINCT i.order_id) AS qtd_pedidos,
           {half_up('CAST(sum(twice) AS BIGINT)', '(2 * count(twice))')} AS nota_media
    FROM v_items i JOIN v_orders o ON o.order_id = i.order_id JOIN v_sellers USING (seller_id)
    LEFT JOIN (SELECT order_id, 2 * avg(review_score) AS twice FROM v_reviews GROUP BY 1) r
      ON r.order_id = i.order_id
    GROUP BY seller_id, seller_state HAVING count(DISTINCT i.order_id) >= 5"""


def monthly_revenue(v: Views) -> DataFrame:
    return g.monthly_revenue(v.orders(), v.order_items())


def revenue_by_state(v: Views) -> DataFrame:
    return g.revenue_by_state(v.orders(), v.order_items(), v.customers())


def delivery_performance(v: Views) -> DataFrame:
    return g.delivery_performance(g.delivered_orders(v.orders()))


def delivery_satisfaction(v: Views) -> DataFrame:
    return g.delivery_satisfaction(g.delivered_orders(v.orders()), v.reviews())


def seller_ranking(v: Views, **options) -> DataFrame:
    return g.seller_ranking(v.order_items(), v.orders(), v.sellers(), v.reviews(), **options)


def _shown(table: str, build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    """A business table in the order in which it is shown."""
    return lambda v: g.present(table, build(v))


def _month_lag(v: Views) -> DataFrame:
    months = g.monthly_revenue(v.orders(), v.order_items())
    return g.previous_month(months, "receita_produtos", "receita_mes_anterior").select(
        "mes", "receita_produtos", "receita_mes_anterior"
    )


def _inner_items(v: Views) -> DataFrame:
    return v.order_items().join(v.orders(), "order_id").select(
        "order_id",
        "order_item_id",
        month_label("order_purchase_timestamp").alias("mes"),
        "order_status",
        "price",
    )


def _left_reviews(v: Views) -> DataFrame:
    heads = v.orders().select("order_id", "order_status")
    return with_matches(heads, v.reviews().select("order_id", "review_id", "review_score"), "order_id")


def _orphan_items(v: Views) -> DataFrame:
    landed = v.raw_orders().select(F.col("order_id").cast("bigint").alias("order_id"))
    return orphans(v.order_items(), "order_id", landed, "order_id").select(
        "order_id", "order_item_id", "price"
    )


QUERIES: dict[str, Query] = {
    "join_inner_items": Query(
        _inner_items,
        with_views(
            """SELECT i.order_id, order_item_id,
                      strftime(order_purchase_timestamp, '%Y-%m') AS mes, order_status,
                      CAST(price AS DOUBLE) AS price
               FROM v_items i JOIN v_orders o ON o.order_id = i.order_id""",
            "v_items",
            "v_orders",
        ),
    ),
    "join_left_reviews": Query(
        _left_reviews,
        with_views(
            """SELECT o.order_id, order_status, review_id, review_score
               FROM v_orders o LEFT JOIN v_reviews r ON r.order_id = o.order_id""",
            "v_orders",
            "v_reviews",
        ),
    ),
    "join_anti_orphans": Query(
        _orphan_items,
        with_views(
            """SELECT order_id, order_item_id, CAST(price AS DOUBLE) AS price FROM v_items i
               WHERE NOT EXISTS (SELECT 1 FROM r_orders o
                                 WHERE CAST(o.order_id AS BIGINT) = i.order_id)""",
            "v_items",
            "r_orders",
        ),
    ),
    "month_lag": Query(
        _month_lag,
        with_views(
            f"""SELECT mes, CAST(cents AS DOUBLE) / 100 AS receita_produtos,
                       CAST(previous AS DOUBLE) / 100 AS receita_mes_anterior
                FROM ({MONTHLY_LAG_SQL})""",
            "v_sales",
        ),
    ),
    "monthly_revenue": Query(
        _shown("receita_mensal", monthly_revenue), with_views(REVENUE_SQL, "v_sales")
    ),
    "revenue_by_state": Query(
        _shown("receita_por_estado", revenue_by_state),
        with_views(STATE_SQL, "v_sales", "v_customers"),
    ),
    "delivery_performance": Query(
        _shown("performance_entrega_mensal", delivery_performance),
        with_views(DELIVERY_SQL, "v_delivered"),
    ),
    "delivery_satisfaction": Query(
        _shown("satisfacao_entrega", delivery_satisfaction),
        with_views(SATISFACTION_SQL, "v_delivered", "v_reviews"),
    ),
    "seller_ranking": Query(
        _shown("ranking_vendedores", seller_ranking),
        with_views(ranking_sql(g.MIN_ORDERS), *RANKING_VIEWS),
    ),
    "seller_ranking_min_orders": Query(
        lambda v: seller_ranking(v, min_orders=RAISED_MIN_ORDERS),
        with_views(ranking_sql(RAISED_MIN_ORDERS), *RANKING_VIEWS),
    ),
    "seller_ranking_order_grain": Query(
        lambda v: seller_ranking(v, review_grain="order"),
        with_views(ORDER_GRAIN_SQL, *RANKING_VIEWS),
    ),
}
