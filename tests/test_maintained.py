"""Business tables from changes against a full rebuild."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cartlayers.plans import gold as g
from cartlayers.plans import maintained as m
from cartlayers.queries import upkeep
from cartlayers.queries.views import Views
from cartlayers.sources.releases import ReleaseStore

ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
    "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp, flag_data_inconsistente boolean"
)
ITEMS = "order_id string, order_item_id string, seller_id string, price decimal(10,2), freight_value decimal(10,2)"
REVIEWS = "review_id string, order_id string, review_score int"
STATES = ["SP", "RJ", None]


def made(rng, n):
    """One random version of an order and what belongs to it: missing values everywhere."""
    import datetime as dt
    from decimal import Decimal

    def day(low, high, missing):
        return None if rng.random() < missing else dt.datetime(2018, 1, 1) + dt.timedelta(days=rng.randint(low, high), hours=5)

    def money():
        return None if rng.random() < 0.2 else Decimal(rng.randint(0, 5000)) / 100

    order = f"o{n}"
    head = (order, f"c{rng.randint(0, 12)}", rng.choice(["delivered", "shipped"]), day(0, 90, 0.1), day(20, 120, 0.2), day(30, 100, 0.2), rng.random() < 0.1)
    items = [(order, str(i), rng.choice(["s1", "s2", "s3", None]), money(), money()) for i in range(rng.randint(0, 4))]
    reviews = [(f"r{n}.{i}", order, rng.choice([1, 3, 5, None])) for i in range(rng.randint(0, 2))]
    return head, items, reviews


def version(spark, orders, customers, extra_items=()):
    heads, items, reviews = [h for h, _, _ in orders.values()], [i for _, g, _ in orders.values() for i in g], [r for _, _, g in orders.values() for r in g]
    return {
        "orders": spark.createDataFrame(heads, ORDERS),
        "order_items": spark.createDataFrame([*items, *extra_items], ITEMS),
        "reviews": spark.createDataFrame(reviews, REVIEWS),
        "customers": spark.createDataFrame(list(customers.items()), "customer_id string, customer_state string"),
        "sellers": spark.createDataFrame([("s1", "SP"), ("s2", None)], "seller_id string, seller_state string"),
    }


def full(t, min_orders=2):
    delivered = g.delivered_orders(t["orders"])
    return {
        "receita_mensal": g.monthly_revenue(t["orders"], t["order_items"]),
        "receita_por_estado": g.revenue_by_state(t["orders"], t["order_items"], t["customers"]),
        "performance_entrega_mensal": g.delivery_performance(delivered),
        "satisfacao_entrega": g.delivery_satisfaction(delivered, t["reviews"]),
        "ranking_vendedores": g.seller_ranking(t["order_items"], t["orders"], t["sellers"], t["reviews"], min_orders),
    }


def content(df):
    return sorted(map(repr, df.collect()))


def assert_same(found, expected):
    for name in m.GROUPS:
        assert found[name].dtypes == expected[name].dtypes, name
        assert content(found[name]) == content(expected[name]), name


@pytest.mark.parametrize("seed", [1, 2])
def test_inserts_changes_and_deletes(spark, tmp_path, seed):
    rng = random.Random(seed)
    store = ReleaseStore(spark, str(tmp_path / "store"))
    orders = {n: made(rng, n) for n in range(60)}
    customers = {f"c{i}": rng.choice(STATES) for i in range(12)}
    before = version(spark, orders, customers)
    sums = m.totals(before)
    assert_same(m.shown(sums, before["sellers"], 2), full(before))
    for step in range(2):
        for n in rng.sample(sorted(orders), 10):
            orders[n] = made(rng, n)
        for n in rng.sample(sorted(orders), 8):
            del orders[n]
        orders |= {n: made(rng, n) for n in range(100 * (step + 1), 100 * (step + 1) + 10)}
        for c in rng.sample(sorted(customers), 3):
            customers[c] = rng.choice(STATES)
        customers.pop(f"c{step}", None)
        customers[f"c{12 + step}"] = "AM"
        # a copied row, and an item without an order id
        extra = [("o3", "0", "s1", None, None), (None, "0", "s1", None, None)] if step else []
        after = version(spark, orders, customers, extra)
        affected = store.open(store.write(m.changed_orders(before, after), "affected"))
        sums = {n: store.open(store.write(df, n)) for n, df in m.refreshed(sums, before, after, affected).items()}
        assert_same(sums, m.totals(after))
        assert_same(m.shown(sums, after["sellers"], 2), full(after))
        before = after


def test_everything_deleted_leaves_no_group(spark):
    rng = random.Random(5)
    orders = {n: made(rng, n) for n in range(20)}
    before = version(spark, orders, {"c1": "SP"})
    after = {n: df.limit(0) for n, df in before.items()}
    sums = m.refreshed(m.totals(before), before, after, m.changed_orders(before, after))
    assert all(df.count() == 0 for df in sums.values())
    back = m.refreshed(sums, after, before, m.changed_orders(after, before))
    assert_same(m.shown(back, before["sellers"], 1), full(before, 1))


def test_nothing_changed_affects_nothing(spark):
    rng = random.Random(6)
    before = version(spark, {n: made(rng, n) for n in range(10)}, {"c1": "SP"})
    assert m.changed_orders(before, before).count() == 0
    assert m.changed_orders(before, before, {}).count() == 0


def test_only_affected_orders_meet(spark):
    """Orders, items and reviews are cut to the affected ids before anything else happens to them."""
    rng = random.Random(7)
    tables = version(spark, {n: made(rng, n) for n in range(10)}, {"c1": "SP"})
    plan = m.totals(tables, tables["orders"].select("order_id").where(F.col("order_id") == "o1"))["receita_mensal"]
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join LeftSemi") == 2 and text.index("Join Inner") < text.index("Join LeftSemi")


@pytest.mark.parametrize(
    "table, column, value, found",
    [
        ("order_items", "order_item_id", "F.lit('z')", False),
        ("orders", "order_status", "F.lit('processing')", False),
        ("reviews", "review_id", "F.lit('z')", False),
        ("orders", "order_status", "F.lit('delivered')", True),
        ("orders", "customer_id", "F.lit('z')", True),
        ("orders", "order_purchase_timestamp", "F.current_timestamp()", True),
        ("orders", "order_delivered_customer_date", "F.current_timestamp()", True),
        ("orders", "order_estimated_delivery_date", "F.current_timestamp()", True),
        ("orders", "flag_data_inconsistente", "~F.col('flag_data_inconsistente')", True),
        ("order_items", "seller_id", "F.lit('z')", True),
        ("order_items", "price", "F.lit(77).cast('decimal(10,2)')", True),
        ("order_items", "freight_value", "F.lit(77).cast('decimal(10,2)')", True),
        ("reviews", "review_score", "F.lit(2)", True),
        ("reviews", "review_id", "F.lit(None).cast('string')", True),
        ("customers", "customer_state", "F.lit('AM')", True),
    ],
)
def test_only_what_totals_read_affects(spark, table, column, value, found):
    order = ("o1", "c1", "shipped", None, None, None, False)
    before = version(spark, {1: (order, [("o1", "0", "s1", None, None)], [("r1", "o1", 1)])}, {"c1": "SP"})
    after = {**before, table: before[table].withColumn(column, eval(value))}
    assert content(m.changed_orders(before, after)) == (["Row(order_id='o1')"] if found else [])


def test_versions_read_stored_views(spark, tmp_path):
    """Items are deduplicated, and orders joined with them, once for both states and all that reads them."""
    views = Views(spark, "/root/testdata/sf0.001")
    for state in upkeep._versions(views, ReleaseStore(spark, str(tmp_path / "store"))):
        for name in ("orders", "order_items"):
            text = state[name]._jdf.queryExecution().optimizedPlan().toString()
            assert "Window" not in text and "Aggregate" not in text and "Join" not in text
        assert content(state["order_items"].where("order_id % 13 <> 5 AND order_id % 19 <> 4 AND order_id >= 0")) == content(
            views.order_items().where("order_id % 13 <> 5 AND order_id % 19 <> 4")
        )
