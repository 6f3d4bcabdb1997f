"""Shape of the physical plans: what must hold for a plan to survive large and skewed tables."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from cartlayers.operators.dedup import keep_first
from cartlayers.plans import gold as g
from cartlayers.plans.layers import typing_report
from cartlayers.queries.cleaning import raw_tables
from cartlayers.queries.views import Views

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Plans as they are for tables too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Views(spark, FOLDER)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(contract.OWN_QUERIES))
def test_no_python_and_no_products(spark, no_broadcast, name):
    plan = plan_of(contract.queries()[name](spark, FOLDER))
    for node in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "collect_list", "collect_set"):
        assert node not in plan


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Cleaned tables as files, so that the plans start at plain scans."""
    views, folder = Views(spark, FOLDER), tmp_path_factory.mktemp("silver")
    tables = {}
    for name in ("orders", "order_items", "customers", "sellers", "reviews"):
        getattr(views, name)().write.parquet(str(folder / name))
        tables[name] = spark.read.parquet(str(folder / name))
    return tables


def exchanges(plan: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning\([^)]*\)|SinglePartition|rangepartitioning\([^)]*\))", plan)


def strip_ids(text: str) -> str:
    return re.sub(r"#\d+L?|, \d+\)", lambda m: ")" if m.group().endswith(")") else "", text)


def test_dedup_limits_each_key_before_the_shuffle(stored):
    plan = plan_of(keep_first(stored["order_items"], ["order_id", "order_item_id"]))
    before_shuffle = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_monthly_revenue_shuffles(no_broadcast, stored):
    plan = plan_of(g.monthly_revenue(stored["orders"], stored["order_items"]))
    # One shuffle per side, already reduced to one row per order on the item side, then one row
    # per month and task. The single partition of the window holds one row per month.
    assert [strip_ids(e) for e in exchanges(plan)] == [
        "SinglePartition",
        "hashpartitioning(month)",
        "hashpartitioning(order_id)",
        "hashpartitioning(order_id)",
    ]
    items = plan[plan.rindex("Exchange") :]
    assert "partial_sum(cast((price" in items
    assert "ReadSchema: struct<order_id:bigint,price:decimal(10,2),freight_value:decimal(10,2)>" in items


def test_revenue_by_state_groups_customers_before_the_join(no_broadcast, stored):
    plan = plan_of(g.revenue_by_state(stored["orders"], stored["order_items"], stored["customers"]))
    assert [strip_ids(e) for e in exchanges(plan)] == [
        "hashpartitioning(estado)",
        "hashpartitioning(customer_id)",
        "hashpartitioning(order_id)",
        "hashpartitioning(order_id)",
        "hashpartitioning(customer_id)",
    ]
    assert "partial_sum(cast(products" in plan.split("hashpartitioning(customer_id")[1]


def test_delivery_performance_moves_only_month_totals(stored):
    plan = plan_of(g.delivery_performance(g.delivered_orders(stored["orders"])))
    assert len(exchanges(plan)) == 1
    assert "PushedFilters: [IsNotNull(order_status)" in plan or "EqualTo(order_status,delivered)" in plan


def test_seller_ranking_never_pairs_items_with_reviews(no_broadcast, stored):
    plan = plan_of(
        g.seller_ranking(stored["order_items"], stored["orders"], stored["sellers"], stored["reviews"])
    )
    scans = plan.split("Exchange")
    items = next(s for s in scans if "partial_sum(cast((price" in s)
    reviews = next(s for s in scans if "partial_count(review_score" in s)
    assert "HashAggregate(keys=[order_id" in items and "HashAggregate(keys=[order_id" in reviews


def test_typing_report_scans_each_table_once(spark):
    plan = plan_of(typing_report(raw_tables(Views(spark, FOLDER))))
    # Seven typed tables; orders, reviews and products are unions with their copies.
    assert plan.count("Scan parquet") == 9
