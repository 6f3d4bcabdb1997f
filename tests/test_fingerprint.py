"""Content checks and quarantined values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from cartlayers.operators.checks import content_match
from cartlayers.operators.fingerprint import fingerprint
from cartlayers.operators.typing import cast_failures, lost_values
from cartlayers.plans.layers import QUARANTINE, bronze_checks, quarantine, quarantine_report, run_bronze, run_silver, typing_report
from cartlayers.registry import TABLES
from cartlayers.sources.releases import ReleaseStore
from cartlayers.sources.tables import read_tables
from tests.landing import write_landing
from tests.test_layers import make_settings

ROWS = [("a", "b", None), ("a", None, "b"), (None, "a", "b"), ("c", "d", ""), ("c", "d", ""), (None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "x string, y string, z string")


def of(spark, rows):
    return tuple(fingerprint(frame(spark, rows).repartition(3)).first())


def test_order_does_not_matter_and_everything_else_does(spark):
    own = of(spark, ROWS)
    assert own[0] == 6 and of(spark, ROWS[::-1]) == own
    changed = [
        [*ROWS[:4], ("c", "d", None), ROWS[5]],
        [("a", None, "b"), ("a", None, "b"), *ROWS[2:]],
        [(None, "b", "a"), *ROWS[1:]],
        [("a", "d", None), *ROWS[1:3], ("c", "b", ""), *ROWS[4:]],
        ROWS[:5],
        [*ROWS, ROWS[0]],
    ]
    for rows in changed:
        assert of(spark, rows) != own
    assert of(spark, []) == (0, 0)


def test_content_match(spark):
    same = content_match(frame(spark, ROWS), frame(spark, ROWS[::-1]), "bronze", "t").first()
    other = content_match(frame(spark, ROWS), frame(spark, [*ROWS[:5], ("x", None, None)]), "bronze", "t").first()
    assert (same.status, same.detalhe) == ("PASSOU", "6 linhas iguais")
    assert (other.status, other.detalhe) == ("FALHOU", "6 linhas, conteúdo diferente")


@pytest.mark.parametrize("recount", [True, False])
def test_a_swapped_cell_fails_the_row_count(spark, tmp_path, recount):
    write_landing(tmp_path, dirty=True)
    settings = make_settings(tmp_path, f"swapped_{recount}")
    rows = run_bronze(spark, settings, "a", recount_source=recount, gate=True)
    store = ReleaseStore.of(spark, settings, "bronze")
    orders = store.current().tables["orders"]
    first = F.col("order_id") == "o1"
    stored = store.open(orders).withColumn("customer_id", F.when(first, F.lit("c2")).otherwise(F.col("customer_id")))
    spoiled = store.write(stored, "orders")
    store.commit({"orders": type(orders)(spoiled.parts, orders.format, orders.schema, orders.notes)})
    found = {r.tabela: (r.status, r.detalhe) for r in bronze_checks(spark, settings, None if recount else rows).collect()}
    assert found.pop("orders") == ("FALHOU", "origem=11, gravado=11, conteúdo diferente")
    assert {s for s, _ in found.values()} == {"PASSOU"}


def test_lost_values_are_kept_with_their_key(spark):
    raw = spark.createDataFrame([("1", "x", "5"), ('q"', None, "5.5"), (None, "7", ""), ("2", "8", None)], "k string, a string, b string")
    types = {"a": "int", "b": "int"}
    found = sorted(map(tuple, lost_values(raw, "t", types, ["k"]).collect()))
    assert found == [
        ("t", '{"k":"1"}', "a", "int", "x"),
        ("t", '{"k":"q\\""}', "b", "int", "5.5"),
        ("t", '{"k":null}', "b", "int", ""),
    ]
    counts = {r.coluna: r.falhas for r in cast_failures(raw, "t", types).collect()}
    assert counts == {"a": 1, "b": 2}
    assert "Exchange" not in lost_values(raw, "t", types, ["k"])._jdf.queryExecution().executedPlan().toString()


def test_the_quarantine_agrees_with_the_report(spark, tmp_path):
    write_landing(tmp_path, dirty=True)
    settings = make_settings(tmp_path, "quarantine")
    run_bronze(spark, settings, "a")
    report = run_silver(spark, settings, "a")
    raw = read_tables(spark, settings, "bronze", TABLES)
    stored = read_tables(spark, settings, "silver", [QUARANTINE])[QUARANTINE]
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, quarantine(raw).collect()))
    expected = sorted(map(tuple, typing_report(raw).collect()))
    assert sorted(map(tuple, quarantine_report(stored).collect())) == expected
    assert sorted(map(tuple, report.typing.collect())) == expected
    prices = [tuple(r) for r in stored.where("coluna = 'price'").collect()]
    assert prices == [("order_items", '{"order_id":"o8","order_item_id":"1"}', "price", "decimal(10,2)", "123456789.12")]
