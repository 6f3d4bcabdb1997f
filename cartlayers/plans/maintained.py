"""Business tables kept up to date from changes, without reading the unchanged orders.

Every business table is a function of sums and counts per group (month, state, delivery state, seller),
and every order adds its own part to them. When rows change, the parts of the affected orders are taken
away as they were and added as they are now; the sums are whole numbers (cents, days, counts), so the
totals are exactly those of a full rebuild. Beside each sum there is the number of values in it, since a
sum of nothing is missing and not zero, and a group without orders goes.

Affected are orders with a changed row in orders, items or reviews, and orders of changed customers, as far
as totals read the rows. Only they are read again, by semi-joins with their ids.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlayers.functions.dates import month_label
from cartlayers.functions.numbers import cents, cents_total, mean_of_totals, money_mean, percent_change, wide
from cartlayers.operators.merge import changed_keys
from cartlayers.operators.rules import FLAG
from cartlayers.plans import gold as g

#: What totals read of the cleaned tables; rows that differ in nothing else add the same to them.
READ = {
    "orders": (
        "order_id", "customer_id", "order_status = 'delivered' AS delivered", "order_purchase_timestamp",
        "order_delivered_customer_date", "order_estimated_delivery_date", FLAG,
    ),
    "order_items": ("order_id", "seller_id", "price", "freight_value"),
    "customers": ("customer_id", "customer_state"),
    "reviews": ("order_id", "review_id IS NOT NULL AS identified", "review_score"),
}
#: The cleaned tables that totals come from; sellers only lend their state when a ranking is shown.
SOURCES = tuple(READ)

#: Group of each business table's totals.
GROUPS = {
    "receita_mensal": "month",
    "receita_por_estado": "estado",
    "performance_entrega_mensal": "month",
    "satisfacao_entrega": "status_entrega",
    "ranking_vendedores": "seller_id",
}
ORDERS = "orders"


def _sums(rows: DataFrame, group: str, **measures: Column) -> DataFrame:
    """Per group: the sum of every measure, how many values it has, and the orders."""
    sums = [F.sum(wide(m)).alias(n) for n, m in measures.items()]
    known = [F.count(m).alias(f"{n}_n") for n, m in measures.items()]
    return rows.groupBy(group).agg(*sums, *known, F.count(F.lit(1)).alias(ORDERS))


def totals(tables: Mapping[str, DataFrame], affected: DataFrame | None = None) -> dict[str, DataFrame]:
    """Totals of every business table, of all orders or of those whose `order_id` is in `affected`."""
    orders, items, reviews = (tables[n] for n in ("orders", "order_items", "reviews"))
    if affected is not None:
        orders, items, reviews = (t.join(affected, "order_id", "left_semi") for t in (orders, items, reviews))
    sales = g.order_sales(orders, items)
    delivered = g.delivered_orders(orders)
    places = tables["customers"].select("customer_id", F.col("customer_state").alias("estado"))
    state = F.when(F.col("no_prazo"), F.lit(g.ON_TIME)).otherwise(F.lit(g.LATE)).alias("status_entrega")
    per_order = g.review_totals(reviews)
    lines = items.groupBy("order_id", "seller_id").agg(
        F.sum(cents("price")).alias("revenue"), F.count(F.lit(1)).alias("items")
    )
    facts = lines.join(orders.select("order_id").join(per_order, "order_id", "left"), "order_id")
    col = F.col
    return {
        "receita_mensal": _sums(sales, "month", products=col("products"), freight=col("freight")),
        "receita_por_estado": _sums(
            sales.join(places, "customer_id"), "estado", products=col("products"), priced=col("priced_items")
        ),
        "performance_entrega_mensal": _sums(
            delivered.withColumn("month", F.trunc("order_purchase_timestamp", "MM")), "month",
            days=col("dias_entrega"), on_time=col("no_prazo").cast("int"),
        ),
        "satisfacao_entrega": _sums(
            delivered.select("order_id", state).join(per_order, "order_id"), "status_entrega",
            score=col("score"), scored=col("scored"), identified=col("identified"),
        ),
        "ranking_vendedores": _sums(
            facts.where(col("seller_id").isNotNull()), "seller_id",
            revenue=wide(col("revenue")) * F.coalesce(col("reviews"), F.lit(1)),
            score=col("items") * col("score"), scored=col("items") * col("scored"),
        ),
    }


def changed_orders(
    before: Mapping[str, DataFrame],
    after: Mapping[str, DataFrame],
    differing: Mapping[str, tuple[DataFrame, DataFrame]] | None = None,
) -> DataFrame:
    """Ids of orders whose part of the totals may differ between two versions of the cleaned tables.

    `differing` has, for every table, the rows of both versions in which they can differ at all (the
    replaced parts); without it whole tables are compared. Tables that it lacks are the same.
    """
    if differing is None:
        differing = {n: (before[n], after[n]) for n in SOURCES}
    differing = {n: [t.selectExpr(*READ[n]) for t in sides] for n, sides in differing.items()}
    found = [
        changed_keys(*differing[n], ["order_id"]) for n in ("orders", "order_items", "reviews") if n in differing
    ]
    if "customers" in differing:
        customers = changed_keys(*differing["customers"], ["customer_id"])
        found += [v["orders"].join(customers, "customer_id", "left_semi").select("order_id") for v in (before, after)]
    if not found:
        return after["orders"].select("order_id").limit(0)
    return reduce(DataFrame.unionByName, found).where("order_id IS NOT NULL").distinct()


def updated(stored: DataFrame, gone: DataFrame, come: DataFrame, group: str) -> DataFrame:
    """Stored totals less those that go and plus those that come; groups left without orders are dropped."""
    measures = [c for c in stored.columns if c != group]
    sides = [stored, gone.select(group, *[(-F.col(m)).alias(m) for m in measures]), come.select(group, *measures)]
    sums = {m: F.sum(F.coalesce(F.col(m), F.lit(0))).cast(stored.schema[m].dataType).alias(m) for m in measures}
    found = reduce(DataFrame.unionByName, sides).groupBy(group).agg(*sums.values()).where(F.col(ORDERS) != 0)
    known = {m: F.when(F.col(f"{m}_n") != 0, F.col(m)) for m in measures if f"{m}_n" in measures}
    return found.withColumns(known).select(stored.columns)


def refreshed(
    stored: Mapping[str, DataFrame],
    before: Mapping[str, DataFrame],
    after: Mapping[str, DataFrame],
    affected: DataFrame,
) -> dict[str, DataFrame]:
    """Totals of `after` from those of `before` and the affected orders of both versions.

    `affected` is read for every table and side: pass a stored frame.
    """
    gone, come = totals(before, affected), totals(after, affected)
    return {n: updated(stored[n], gone[n], come[n], GROUPS[n]) for n in GROUPS}


def _months(sums: DataFrame) -> DataFrame:
    months = sums.select(
        month_label("month").alias("mes"), cents_total(F.col("products")).alias("receita_produtos"),
        cents_total(F.col("freight")).alias("receita_frete"), F.col(ORDERS).alias("qtd_pedidos"),
    )
    change = percent_change(F.col("receita_produtos"), F.col("previous"))
    return g.previous_month(months, "receita_produtos", "previous").withColumn("variacao_pct", change).drop("previous")


def _states(sums: DataFrame) -> DataFrame:
    revenue = cents_total(F.col("products"))
    return sums.select(
        "estado", revenue.alias("receita_total"), F.col(ORDERS).alias("qtd_pedidos"),
        money_mean(revenue, F.col("priced")).alias("ticket_medio"),
    )


def _deliveries(sums: DataFrame) -> DataFrame:
    on_time = F.round(F.try_divide(F.col("on_time").cast("double"), F.col("on_time_n")) * 100, 2)
    days = F.round(F.try_divide(F.col("days").cast("double"), F.col("days_n")), 1)
    return sums.select(
        month_label("month").alias("mes"), days.alias("tempo_medio_entrega_dias"),
        on_time.alias("pct_entregas_no_prazo"), F.col(ORDERS).alias("qtd_pedidos_entregues"),
        F.round(100 - on_time, 2).alias("pct_entregas_atrasadas"),
    )


def _mean_score() -> Column:
    return mean_of_totals(F.col("score").cast("bigint"), F.col("scored").cast("bigint")).alias("nota_media")


def _satisfaction(sums: DataFrame) -> DataFrame:
    return sums.select("status_entrega", _mean_score(), F.col("identified").cast("bigint").alias("qtd_avaliacoes"))


def _ranking(sums: DataFrame, sellers: DataFrame, min_orders: int) -> DataFrame:
    ranked = sums.where(F.col(ORDERS) >= min_orders).select(
        "seller_id", cents_total(F.col("revenue")).alias("receita_total"), F.col(ORDERS).alias("qtd_pedidos"), _mean_score()
    )
    return ranked.join(sellers.select("seller_id", "seller_state"), "seller_id").select(
        "seller_id", "seller_state", "receita_total", "qtd_pedidos", "nota_media"
    )


def shown(
    sums: Mapping[str, DataFrame], sellers: DataFrame, min_orders: int = g.MIN_ORDERS
) -> dict[str, DataFrame]:
    """The business tables that totals stand for; each has few rows, or one per seller.

    The ranking counts prices once per review, as `seller_ranking` does by default.
    """
    builders = {
        "receita_mensal": _months,
        "receita_por_estado": _states,
        "performance_entrega_mensal": _deliveries,
        "satisfacao_entrega": _satisfaction,
        "ranking_vendedores": lambda df: _ranking(df, sellers, min_orders),
    }
    return {name: builders[name](df) for name, df in sums.items()}
