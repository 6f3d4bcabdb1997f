"""Results do not depend on row order or partitioning, and agree with a plain computation."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from cartlayers.functions.numbers import money_mean, percent_change
from cartlayers.operators.dedup import dedup_report, keep_first
from cartlayers.operators.typing import apply_types, cast_failures
from cartlayers.plans import gold as g

ITEMS = "order_id string, order_item_id string, seller_id string, price decimal(10,2), freight_value decimal(10,2)"
ORDERS = (
    "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, "
    "order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp, "
    "flag_data_inconsistente boolean"
)


@pytest.fixture(scope="module")
def shop(spark):
    """A random shop in which one order holds a third of the items and of the reviews."""
    rng = random.Random(7)
    import datetime as dt

    orders, items, reviews = [], [], []
    for i in range(60):
        bought = dt.datetime(2017, 1, 1) + dt.timedelta(days=rng.randrange(200))
        done = None if rng.random() < 0.1 else bought + dt.timedelta(days=rng.randrange(-2, 30))
        due = None if rng.random() < 0.1 else bought + dt.timedelta(days=15)
        flag = done is not None and done < bought
        status = rng.choice(["delivered", "delivered", "shipped"])
        orders.append((f"o{i}", f"c{rng.randrange(20)}", status, bought, done, due, flag))
    for n in range(300):
        order = "o0" if n % 3 == 0 else f"o{rng.randrange(64)}"
        price = None if rng.random() < 0.05 else Decimal(rng.randrange(1, 9999)) / 100
        items.append((order, str(n), f"s{rng.randrange(8)}", price, Decimal(rng.randrange(900)) / 100))
    items.append((None, "1", "s1", Decimal("5.00"), Decimal("1.00")))
    for n in range(90):
        order = "o0" if n % 3 == 0 else f"o{rng.randrange(64)}"
        score = None if rng.random() < 0.1 else rng.randrange(1, 6)
        reviews.append((f"r{n}", order, score))
    customers = [(f"c{i}", f"st{i % 4}") for i in range(18)]
    sellers = [(f"s{i}", f"st{i % 3}") for i in range(7)]
    rows = {"orders": orders, "items": items, "reviews": reviews, "customers": customers, "sellers": sellers}
    schemas = {
        "orders": ORDERS,
        "items": ITEMS,
        "reviews": "review_id string, order_id string, review_score int",
        "customers": "customer_id string, customer_state string",
        "sellers": "seller_id string, seller_state string",
    }
    return rows, {n: spark.createDataFrame(rows[n], schemas[n]) for n in rows}


def half_up(value, places) -> Decimal:
    return Decimal(value).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)


def by_key(df, *key):
    return {tuple(r[k] for k in key): r for r in df.collect()}


def test_monthly_revenue_equals_brute_force(shop):
    rows, t = shop
    months = {o[0]: o[3].strftime("%Y-%m") for o in rows["orders"]}
    money, freight, orders = defaultdict(Decimal), defaultdict(Decimal), defaultdict(set)
    for order, _, _, price, ship in rows["items"]:
        if order in months:
            money[months[order]] += price or 0
            freight[months[order]] += ship
            orders[months[order]].add(order)
    found = by_key(g.monthly_revenue(t["orders"], t["items"]), "mes")
    assert set(found) == {(m,) for m in money}
    previous = None
    for month in sorted(money):
        row = found[(month,)]
        assert (row.receita_produtos, row.receita_frete, row.qtd_pedidos) == (
            money[month],
            freight[month],
            len(orders[month]),
        )
        change = None if previous is None else half_up((money[month] - previous) / previous * 100, 2)
        assert row.variacao_pct == change
        previous = money[month]


def test_revenue_by_state_equals_brute_force(shop):
    rows, t = shop
    customer = {o[0]: o[1] for o in rows["orders"]}
    state = dict(rows["customers"])
    prices, orders = defaultdict(list), defaultdict(set)
    for order, _, _, price, _ in rows["items"]:
        place = state.get(customer.get(order))
        if place:
            orders[place].add(order)
            if price is not None:
                prices[place].append(price)
    found = by_key(g.revenue_by_state(t["orders"], t["items"], t["customers"]), "estado")
    assert set(found) == {(s,) for s in orders}
    for place in orders:
        row = found[(place,)]
        mean = half_up(half_up(sum(prices[place]) / len(prices[place]), 6), 2)
        assert (row.receita_total, row.qtd_pedidos, row.ticket_medio) == (
            sum(prices[place]),
            len(orders[place]),
            mean,
        )


def test_delivery_tables_equal_brute_force(shop):
    rows, t = shop
    delivered = {}
    for order, _, status, bought, done, due, flag in rows["orders"]:
        if status == "delivered" and done is not None and not flag:
            delivered[order] = (bought, done, due)
    frame = g.delivered_orders(t["orders"])
    found = by_key(frame, "order_id")
    assert {k[0] for k in found} == set(delivered)
    months, scores, seen = defaultdict(list), defaultdict(list), defaultdict(int)
    for order, (bought, done, due) in delivered.items():
        on_time = None if due is None else done <= due
        assert found[(order,)].no_prazo == on_time
        months[bought.strftime("%Y-%m")].append(((done.date() - bought.date()).days, on_time))
        for _, reviewed, score in rows["reviews"]:
            if reviewed == order:
                label = "no_prazo" if on_time else "atrasado"
                seen[label] += 1
                if score is not None:
                    scores[label].append(score)
    monthly = by_key(g.delivery_performance(frame), "mes")
    for month, values in months.items():
        row = monthly[(month,)]
        known = [v for _, v in values if v is not None]
        assert row.qtd_pedidos_entregues == len(values)
        mean = half_up(Decimal(sum(d for d, _ in values)) / len(values), 1)
        assert row.tempo_medio_entrega_dias == float(mean)
        if known:
            assert row.pct_entregas_no_prazo == float(half_up(Decimal(100 * sum(known)) / len(known), 2))
            assert row.pct_entregas_no_prazo + row.pct_entregas_atrasadas == pytest.approx(100)
        else:
            assert row.pct_entregas_no_prazo is None
    satisfaction = by_key(g.delivery_satisfaction(frame, t["reviews"]), "status_entrega")
    assert {k[0] for k in satisfaction} == set(seen)
    for label in seen:
        row = satisfaction[(label,)]
        assert row.qtd_avaliacoes == seen[label]
        assert row.nota_media == float(half_up(Decimal(sum(scores[label])) / len(scores[label]), 2))


@pytest.mark.parametrize("grain", ["row", "order"])
@pytest.mark.parametrize("minimum", [1, 5, 20])
def test_seller_ranking_equals_brute_force(shop, grain, minimum):
    rows, t = shop
    known = {o[0] for o in rows["orders"]}
    states = dict(rows["sellers"])
    reviews = defaultdict(list)
    for _, order, score in rows["reviews"]:
        reviews[order].append(score)
    money, orders, scores = defaultdict(Decimal), defaultdict(set), defaultdict(list)
    for order, _, seller, price, _ in rows["items"]:
        if order not in known or seller not in states:
            continue
        orders[seller].add(order)
        mine = reviews.get(order, [])
        given = [s for s in mine if s is not None]
        if grain == "row":
            money[seller] += (price or 0) * max(len(mine), 1)
            scores[seller] += given
        else:
            money[seller] += price or 0
            if given:
                scores[seller].append(Decimal(sum(given)) / len(given))
    ranking = g.seller_ranking(
        t["items"], t["orders"], t["sellers"], t["reviews"], minimum, review_grain=grain
    )
    found = by_key(ranking, "seller_id")
    assert {k[0] for k in found} == {s for s in orders if len(orders[s]) >= minimum}
    for (seller,), row in found.items():
        mean = float(half_up(Decimal(sum(scores[seller])) / len(scores[seller]), 2))
        assert (row.seller_state, row.receita_total, row.qtd_pedidos, row.nota_media) == (
            states[seller],
            money[seller],
            len(orders[seller]),
            mean,
        )


def test_unknown_review_grain(shop):
    _, t = shop
    with pytest.raises(ValueError, match="review_grain"):
        g.seller_ranking(t["items"], t["orders"], t["sellers"], t["reviews"], review_grain="x")


def test_dedup_is_stable_unique_and_idempotent(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, None]), rng.randrange(50), "t") for _ in range(200)]
    schema = "k string, j int, v int, w string"
    results = []
    for seed, parts in ((1, 1), (2, 3), (3, 7)):
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        df = keep_first(spark.createDataFrame(shuffled, schema).repartition(parts), ["k", "j"])
        results.append(sorted(map(tuple, df.collect()), key=str))
        assert sorted(map(tuple, keep_first(df, ["k", "j"]).collect()), key=str) == results[-1]
    assert results[0] == results[1] == results[2]
    expected = {}
    for k, j, v, w in rows:
        expected[k, j] = min(expected.get((k, j), (v, w)), (v, w))
    assert {(r[0], r[1]): (r[2], r[3]) for r in results[0]} == expected
    report = dedup_report(spark.createDataFrame(rows, schema), "t", ["k", "j"]).first()
    assert (report.linhas, report.chaves, report.removidas) == (200, len(expected), 200 - len(expected))


def test_dedup_keeps_values_before_null_and_obeys_a_given_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", None, "z"), ("a", 1, "y")], "k string, v int, w string")
    assert keep_first(df, ["k"]).first().w == "y"
    assert keep_first(df, ["k"], ["w"]).first().v == 2
    assert keep_first(df.select("k"), ["k"]).count() == 1


def test_results_do_not_depend_on_shuffle_partitions(spark, shop):
    _, t = shop
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for parts in ("1", "5"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            ranking = g.seller_ranking(t["items"], t["orders"], t["sellers"], t["reviews"])
            results.append(sorted(map(tuple, ranking.collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_gold_totals_equal_silver_total_without_orphans(shop):
    _, t = shop
    items = t["items"].join(t["orders"].select("order_id"), "order_id")
    total = items.agg(F.sum("price")).first()[0]
    monthly = g.monthly_revenue(t["orders"], items).agg(F.sum("receita_produtos")).first()[0]
    assert monthly == total


def test_casts(spark):
    df = spark.createDataFrame(
        [("1.005", " 7 ", "NaN", "2017-13-01"), ("123456789.12", "", "x", ""), (None, "5.0", "2.5", "2017-01-02 03:04:05")],
        "m string, i string, d string, t string",
    )
    types = {"m": "decimal(10,2)", "i": "int", "d": "double", "t": "timestamp"}
    rows = apply_types(df, types).collect()
    assert [r.m for r in rows] == [Decimal("1.01"), None, None]
    assert [r.i for r in rows] == [7, None, None]
    assert rows[0].d != rows[0].d and [r.d for r in rows[1:]] == [None, 2.5]
    assert [r.t is None for r in rows] == [True, True, False]
    lost = {r.coluna: r.falhas for r in cast_failures(df, "t", types).collect()}
    assert lost == {"m": 1, "i": 2, "d": 1, "t": 2}


def test_percent_change_and_money_mean(spark):
    df = spark.createDataFrame(
        [(Decimal("1.00"), Decimal("0.00"), 3), (Decimal("2.00"), Decimal("3.00"), 0), (Decimal("1.00"), None, 8)],
        "a decimal(20,2), b decimal(20,2), n bigint",
    )
    rows = df.select(
        percent_change(F.col("a"), F.col("b")).alias("change"), money_mean(F.col("a"), F.col("n")).alias("mean")
    ).collect()
    assert [r.change for r in rows] == [None, Decimal("-33.33"), None]
    assert [r["mean"] for r in rows] == [Decimal("0.33"), None, Decimal("0.13")]
