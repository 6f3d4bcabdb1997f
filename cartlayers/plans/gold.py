"""Business tables.

Inputs are cleaned tables, so `order_id`, `customer_id` and `seller_id` are unique in the orders,
customers and sellers tables (the silver checks verify it). The builders use that to total the
large side per key before it meets the other side: equal keys combine on the map side, a key with
a large share of the rows crosses the network as one row per task, and counting distinct orders
becomes counting rows, which needs no shuffle of its own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartlayers.functions.dates import days_between, month_label, month_start
from cartlayers.functions.numbers import (
    cents,
    cents_total,
    mean_of_totals,
    money_mean,
    percent_change,
    wide,
)
from cartlayers.operators.checks import (
    Check,
    RowRule,
    below,
    category_check,
    missing,
    negative,
    outside,
    rule_check,
    sum_check,
    verdicts_of,
)
from cartlayers.operators.rules import FLAG
from cartlayers.sources.landing import without_audit

# The two delivery states, and the fewest orders a ranked seller has.
ON_TIME = "no_prazo"
LATE = "atrasado"
MIN_ORDERS = 5

# How each business table is sorted when it is read; stored tables have no order.
PRESENTATION: dict[str, list[tuple[str, bool]]] = {
    "receita_mensal": [("mes", True)],
    "receita_por_estado": [("receita_total", False), ("estado", True)],
    "performance_entrega_mensal": [("mes", True)],
    "satisfacao_entrega": [("status_entrega", True)],
    "ranking_vendedores": [("receita_total", False), ("seller_id", True)],
}


def present(name: str, df: DataFrame) -> DataFrame:
    """A business table in the order in which it is shown."""
    return df.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in PRESENTATION[name]])


def _rows() -> Column:
    return F.count(F.lit(1))


def order_sales(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per order that has items: month, customer and item totals in cents."""
    totals = items.groupBy("order_id").agg(
        F.sum(cents("price")).alias("products"),
        F.sum(cents("freight_value")).alias("freight"),
        F.count("price").alias("priced_items"),
    )
    heads = orders.select(
        "order_id", "customer_id", month_start("order_purchase_timestamp").alias("month")
    )
    return heads.join(totals, "order_id")


def previous_month(months: DataFrame, measure: str, alias: str) -> DataFrame:
    """Add the measure of the previous row by month; a missing month sorts first.

    The window has no partition key: its input is one row per month.
    """
    by_month = Window.orderBy(F.col("mes").asc_nulls_first())
    return months.withColumn(alias, F.lag(measure).over(by_month))


def monthly_revenue_of(sales: DataFrame) -> DataFrame:
    months = (
        sales.groupBy("month")
        .agg(
            cents_total(F.sum(wide(F.col("products")))).alias("receita_produtos"),
            cents_total(F.sum(wide(F.col("freight")))).alias("receita_frete"),
            _rows().alias("qtd_pedidos"),
        )
        .select(month_label("month").alias("mes"), "receita_produtos", "receita_frete", "qtd_pedidos")
    )
    change = percent_change(F.col("receita_produtos"), F.col("previous"))
    return (
        previous_month(months, "receita_produtos", "previous")
        .withColumn("variacao_pct", change)
        .drop("previous")
    )


def monthly_revenue(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Product and freight revenue, orders and change against the previous row, per month."""
    return monthly_revenue_of(order_sales(orders, items))


def revenue_by_state_of(sales: DataFrame, customers: DataFrame) -> DataFrame:
    per_customer = sales.groupBy("customer_id").agg(
        F.sum(wide(F.col("products"))).alias("products"),
        F.sum("priced_items").alias("priced_items"),
        _rows().alias("orders"),
    )
    places = customers.select("customer_id", F.col("customer_state").alias("estado"))
    return (
        per_customer.join(places, "customer_id")
        .groupBy("estado")
        .agg(
            cents_total(F.sum("products")).alias("receita_total"),
            F.sum("orders").alias("qtd_pedidos"),
            money_mean(cents_total(F.sum("products")), F.sum("priced_items")).alias("ticket_medio"),
        )
    )


def revenue_by_state(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue, orders and mean item price per customer state."""
    return revenue_by_state_of(order_sales(orders, items), customers)


def delivered_orders(orders: DataFrame) -> DataFrame:
    """Delivered orders with consistent dates, their delivery days and whether they were on time.

    `no_prazo` is NULL without an estimated date.
    """
    delivered = F.col("order_delivered_customer_date")
    return (
        without_audit(orders)
        .filter((F.col("order_status") == "delivered") & delivered.isNotNull() & ~F.col(FLAG))
        .withColumns(
            {
                "mes": month_label("order_purchase_timestamp"),
                "dias_entrega": days_between(
                    "order_purchase_timestamp", "order_delivered_customer_date"
                ),
                "no_prazo": delivered <= F.col("order_estimated_delivery_date"),
            }
        )
    )


def on_time_percent(on_time: str) -> Column:
    """Share of true values among known ones, in percent."""
    return F.round(F.avg(F.col(on_time).cast("int")) * 100, 2)


def delivery_performance(delivered: DataFrame) -> DataFrame:
    """Mean delivery days and on-time and late percentages per month of purchase."""
    return (
        delivered.groupBy(month_start("order_purchase_timestamp").alias("month"))
        .agg(
            F.round(F.avg("dias_entrega"), 1).alias("tempo_medio_entrega_dias"),
            on_time_percent("no_prazo").alias("pct_entregas_no_prazo"),
            _rows().alias("qtd_pedidos_entregues"),
        )
        .select(
            month_label("month").alias("mes"),
            "tempo_medio_entrega_dias",
            "pct_entregas_no_prazo",
            "qtd_pedidos_entregues",
            F.round(100 - F.col("pct_entregas_no_prazo"), 2).alias("pct_entregas_atrasadas"),
        )
    )


def review_totals(reviews: DataFrame) -> DataFrame:
    """One row per order: its review rows, identified reviews, scored reviews and score total."""
    return reviews.groupBy("order_id").agg(
        _rows().alias("reviews"),
        F.count("review_id").alias("identified"),
        F.count("review_score").alias("scored"),
        F.sum("review_score").alias("score"),
    )


def delivery_satisfaction(delivered: DataFrame, reviews: DataFrame) -> DataFrame:
    """Mean score and number of reviews of on-time and late deliveries.

    An order without an estimated date counts as late.
    """
    state = F.when(F.col("no_prazo"), F.lit(ON_TIME)).otherwise(F.lit(LATE))
    return (
        delivered.select("order_id", state.alias("status_entrega"))
        .join(review_totals(reviews), "order_id")
        .groupBy("status_entrega")
        .agg(
            mean_of_totals(F.sum("score"), F.sum("scored")).alias("nota_media"),
            F.sum("identified").alias("qtd_avaliacoes"),
        )
    )


def seller_ranking(
    items: DataFrame,
    orders: DataFrame,
    sellers: DataFrame,
    reviews: DataFrame,
    min_orders: int = MIN_ORDERS,
    review_grain: str = "row",
) -> DataFrame:
    """Revenue, orders and mean score of sellers with at least `min_orders` orders.

    With `review_grain="row"` every item meets every review of its order: an order reviewed twice
    counts its prices twice and a score weighs as many times as the order has items. The counts of
    both sides give these products, so the pairs are never built. `review_grain="order"` counts
    prices once and gives each item the mean score of its order.
    """
    if review_grain not in ("row", "order"):
        raise ValueError(f"unknown review_grain: {review_grain!r}")
    lines = items.groupBy("order_id", "seller_id").agg(
        F.sum(cents("price")).alias("revenue"), _rows().alias("items")
    )
    heads = orders.select("order_id").join(review_totals(reviews), "order_id", "left")
    facts = lines.join(heads, "order_id")
    if review_grain == "row":
        revenue = wide(F.col("revenue")) * F.coalesce(F.col("reviews"), F.lit(1))
        score = mean_of_totals(
            F.sum(F.col("items") * F.col("score")), F.sum(F.col("items") * F.col("scored"))
        )
    else:
        revenue = wide(F.col("revenue"))
        order_mean = F.try_divide(F.col("score"), F.col("scored"))
        score = mean_of_totals(
            F.sum(F.col("items") * order_mean),
            F.sum(F.when(order_mean.isNotNull(), F.col("items"))),
        )
    per_seller = (
        facts.groupBy("seller_id")
        .agg(
            cents_total(F.sum(revenue)).alias("receita_total"),
            _rows().alias("qtd_pedidos"),
            score.alias("nota_media"),
        )
        .filter(F.col("qtd_pedidos") >= min_orders)
    )
    return per_seller.join(sellers.select("seller_id", "seller_state"), "seller_id").select(
        "seller_id", "seller_state", "receita_total", "qtd_pedidos", "nota_media"
    )


def gold_checks(
    gold: Mapping[str, DataFrame], items: DataFrame, min_orders: int = MIN_ORDERS
) -> DataFrame:
    """Verdicts of all business tables, read back from storage: one aggregate of each and of the items."""
    silver = items.agg(F.sum("price").alias("silver"))
    # One row per seller: how often it is listed, and whether below the minimum.
    sellers = gold["ranking_vendedores"].groupBy("seller_id").agg(
        _rows().alias("copies"), F.count_if(below("qtd_pedidos", min_orders)).alias("few")
    )
    frames = {**gold, "ranking_vendedores": sellers}
    # Check names and the words of their details, as found in the log.
    listed = Check(
        "ranking_vendedores",
        "chave_unica_seller_id",
        {"linhas": F.coalesce(F.sum("copies"), F.lit(0)), "chaves": _rows()},
        F.col("linhas") == F.col("chaves"),
        F.concat(F.col("linhas").cast("string"), F.lit(" vs "), F.col("chaves").cast("string")),
    )
    few = Check(
        "ranking_vendedores",
        "filtro_minimo_pedidos_respeitado",
        {"few": F.coalesce(F.sum("few"), F.lit(0))},
        F.col("few") == 0,
        F.concat(F.col("few").cast("string"), F.lit(" abaixo do mínimo")),
    )
    checks = [
        sum_check("receita_mensal", "receita_produtos", "silver"),
        rule_check(
            "receita_mensal",
            RowRule("sem_valores_negativos", negative("receita_produtos"), "negativos"),
        ),
        sum_check("receita_por_estado", "receita_total", "silver"),
        rule_check("receita_por_estado", RowRule("sem_estado_nulo", missing("estado"), "nulos")),
        rule_check(
            "performance_entrega_mensal",
            RowRule(
                "percentual_no_intervalo_0_100",
                outside("pct_entregas_no_prazo", 0, 100),
                "fora do intervalo",
            ),
        ),
        rule_check(
            "performance_entrega_mensal",
            RowRule("tempo_entrega_nao_negativo", negative("tempo_medio_entrega_dias"), "negativos"),
        ),
        rule_check(
            "satisfacao_entrega",
            RowRule("nota_media_no_intervalo_1_5", outside("nota_media", 1, 5), "fora do intervalo"),
        ),
        category_check("satisfacao_entrega", "status_entrega", (ON_TIME, LATE)),
        listed,
        few,
    ]
    return verdicts_of(checks, frames, "gold", silver)
