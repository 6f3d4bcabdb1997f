"""The three layers end to end on landing files."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cartlayers.__main__ import main
from cartlayers.operators.checks import QualityGateError, enforce, log_summary, record_check
from cartlayers.plans.gold import PRESENTATION
from cartlayers.plans.layers import (
    bronze_checks,
    dedup_summary,
    run_all,
    run_bronze,
    run_gold,
    run_silver,
)
from cartlayers.registry import TABLES
from cartlayers.session import pinned
from cartlayers.settings import Settings
from cartlayers.sources.landing import read_landing
from cartlayers.sources.tables import drop_tables, overwrite_table, read_table, stage
from tests.landing import PREFIX, write_landing


def make_settings(folder, name: str) -> Settings:
    return Settings(
        raw_path=str(folder),
        file_prefix=PREFIX,
        bronze=f"bronze_{name}",
        silver=f"silver_{name}",
        gold=f"gold_{name}",
    )


@pytest.fixture(scope="module")
def clean_run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("clean")
    write_landing(folder, dirty=False)
    settings = make_settings(folder, "clean")
    return settings, run_all(spark, settings, gate_layers=("bronze", "silver", "gold")).run_id


@pytest.fixture(scope="module")
def dirty_run(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("dirty")
    write_landing(folder, dirty=True)
    settings = make_settings(folder, "dirty")
    rows = run_bronze(spark, settings, "run1", gate=True)
    lost = run_silver(spark, settings, "run1")
    return settings, rows, {(r.tabela, r.coluna): r.falhas for r in lost.typing.collect()}


def rows_of(spark, settings, layer, table, *order):
    return [tuple(r) for r in read_table(spark, settings, layer, table).orderBy(*order).collect()]


def log_of(spark, settings, layer):
    rows = spark.table(settings.log_table).filter(F.col("camada") == layer).collect()
    return {(r.tabela, r.checagem): (r.status, r.detalhe) for r in rows}


def test_bronze_is_text_with_audit_columns(spark, dirty_run):
    settings, rows, _ = dirty_run
    reviews = read_table(spark, settings, "bronze", "reviews")
    assert [f.dataType.simpleString() for f in reviews.schema][:-2] == ["string"] * 6
    assert reviews.columns[-2:] == ["_ingest_timestamp", "_source_file"]
    assert {r[0] for r in reviews.select("_source_file").distinct().collect()} == {
        f"{PREFIX}order_reviews_dataset.csv"
    }
    assert rows["reviews"] == reviews.count() == 7
    comment = reviews.filter("review_score = '5'").first().review_comment_message
    assert comment == 'said "great",\nwould buy again'


def test_reader_options_are_needed_for_line_breaks(spark, dirty_run):
    settings, _, _ = dirty_run
    path = settings.landing_path(TABLES["reviews"].file)
    assert read_landing(spark, path).count() > 7


def test_bronze_checks_pass_and_count_the_stored_table(spark, dirty_run):
    settings, _, _ = dirty_run
    log = log_of(spark, settings, "bronze")
    assert len(log) == 9 and {s for s, _ in log.values()} == {"PASSOU"}
    assert log["orders", "contagem_linhas_vs_origem"][1] == "origem=11, gravado=11"


def test_observed_and_recounted_rows_agree(spark, clean_run, tmp_path):
    write_landing(tmp_path, dirty=False)
    settings = make_settings(tmp_path, "recount")
    run_bronze(spark, settings, "a", recount_source=False)
    run_bronze(spark, settings, "b")
    details = [
        {(r.tabela, r.detalhe) for r in spark.table(settings.log_table).filter(f"run_id = '{i}'").collect()}
        for i in ("a", "b")
    ]
    assert details[0] == details[1] and len(details[0]) == 9


def test_typing_report_counts_lost_values_only(dirty_run):
    _, _, lost = dirty_run
    assert {k: n for k, n in lost.items() if n} == {
        ("orders", "order_purchase_timestamp"): 1,
        ("orders", "order_approved_at"): 1,
        ("order_items", "price"): 1,
        ("payments", "payment_value"): 1,
        ("reviews", "review_creation_date"): 1,
        ("reviews", "review_score"): 1,
        ("products", "product_name_lenght"): 1,
        ("products", "product_weight_g"): 1,
        ("geolocation", "geolocation_lat"): 1,
    }
    assert len(lost) == 25


def test_silver_orders(spark, dirty_run):
    settings, _, _ = dirty_run
    orders = read_table(spark, settings, "silver", "orders")
    flags = {r.order_id: r.flag_data_inconsistente for r in orders.collect()}
    assert flags == {**{f"o{i}": False for i in (1, 2, 3, 4, 5, 7, 8)}, "o6": True}
    kept = orders.filter("order_id = 'o1'").first()
    assert kept.order_status == "delivered"
    assert kept.order_purchase_timestamp == dt.datetime(2017, 11, 3, 10)
    assert orders.filter("order_id = 'o8'").first().order_purchase_timestamp is None


def test_silver_order_items(spark, dirty_run):
    settings, _, _ = dirty_run
    items = read_table(spark, settings, "silver", "order_items")
    prices = {(r.order_id, r.order_item_id): r.price for r in items.collect()}
    assert len(prices) == 13
    assert prices["o1", "1"] == Decimal("10.00")
    assert prices["o4", "1"] == Decimal("1.01")
    assert prices["o8", "1"] is None
    assert prices[None, "1"] == Decimal("4.00")


def test_silver_text_rules(spark, dirty_run):
    settings, _, _ = dirty_run
    customers = read_table(spark, settings, "silver", "customers")
    assert {r.customer_state for r in customers.collect()} == {"SP", "RJ"}
    assert customers.filter("customer_id = 'c1'").first().customer_city == "\titu"
    assert customers.filter("customer_id = 'c2'").first().customer_city == "são paulo"
    sellers = {r.seller_id: (r.seller_city, r.seller_state) for r in read_table(spark, settings, "silver", "sellers").collect()}
    assert sellers == {"s5": ("curitiba", "PR"), "s4": ("\titu", "SP")}


def test_silver_products(spark, dirty_run):
    settings, _, _ = dirty_run
    products = read_table(spark, settings, "silver", "products")
    names = {r.product_id: r.product_category_name for r in products.collect()}
    # A blank category is not missing: it is trimmed after the default was filled in.
    assert names == {"p1": "nao_informado", "p2": "nao_informado", "p3": "", "p4": "perfumaria"}
    assert products.schema["product_weight_g"].dataType.simpleString() == "double"


def test_silver_reviews_and_payments(spark, dirty_run):
    settings, _, _ = dirty_run
    scores = {r.review_id: r.review_score for r in read_table(spark, settings, "silver", "reviews").collect()}
    assert scores == {"r1": 1, "r2": 4, "r3": 1, "r4": 2, "r5": None, "r9": 9}
    payments = rows_of(spark, settings, "silver", "payments", "order_id", "payment_value")
    assert [(r[0], r[1], r[2]) for r in payments] == [
        ("o1", 1, Decimal("44.00")),
        ("o1", 1, Decimal("44.00")),
        ("o2", 7, None),
        ("o3", None, Decimal("27.00")),
    ]


def test_silver_dimensions(spark, dirty_run):
    settings, _, _ = dirty_run
    geo = rows_of(spark, settings, "silver", "geolocation", "geolocation_zip_code_prefix")
    assert [(z, round(a, 6), round(o, 6), c, s) for z, a, o, c, s in geo] == [
        ("01310", -23.6, -46.7, "são paulo", "SP"),
        ("20000", -22.9, -43.2, None, "RJ"),
    ]
    names = read_table(spark, settings, "silver", "category_translation")
    kept = {r[0]: r[1] for r in names.select(*TABLES["category_translation"].lower).collect()}
    assert kept == {"perfumaria": "health", "moveis": "furniture"}


def test_silver_checks(spark, dirty_run):
    settings, _, _ = dirty_run
    log = log_of(spark, settings, "silver")
    assert len(log) == 13
    failed = {k: d for k, (s, d) in log.items() if s == "FALHOU"}
    # The orders of two items are missing, one of them because it has no order id at all.
    assert failed == {("order_items", "integridade_order_id_para_orders"): "2 órfãos"}
    assert log["orders", "chave_unica_order_id"] == ("PASSOU", "8 vs 8")


def test_dedup_summary(spark, dirty_run):
    settings, _, _ = dirty_run
    raw = {n: read_table(spark, settings, "bronze", n) for n in TABLES}
    stored = {n: read_table(spark, settings, "silver", n) for n in TABLES}
    found = dedup_summary(raw, stored).collect()
    # One of the three missing orders has no key: it is dropped, not a copy.
    assert {r.tabela: r.descartadas for r in found if r.descartadas} == {"orders": 1}
    assert {r.tabela: r.removidas for r in found} == {
        "orders": 2,
        "customers": 1,
        "order_items": 1,
        "reviews": 1,
        "products": 0,
        "sellers": 0,
        "category_translation": 1,
    }


def test_gold_gate_stops_the_dirty_run(spark, dirty_run):
    settings, _, _ = dirty_run
    with pytest.raises(QualityGateError, match="2 quality"):
        run_gold(spark, settings, "run1")
    failed = {k: d for k, (s, d) in log_of(spark, settings, "gold").items() if s == "FALHOU"}
    assert failed == {
        ("receita_mensal", "reconciliacao_com_silver"): "gold=140.01, silver=147.01",
        ("receita_por_estado", "reconciliacao_com_silver"): "gold=140.01, silver=147.01",
    }
    log = spark.table(settings.log_table)
    enforce(log, "bronze", "run1")
    with pytest.raises(QualityGateError, match="no verdicts"):
        enforce(log, "gold", "another run")
    with pytest.raises(QualityGateError):
        enforce(log)
    # Nothing was published and nothing of the run is left.
    assert {t.name for t in spark.catalog.listTables(settings.gold)} == {"quality_log"}
    run_gold(spark, settings, "run2", gate=False)
    # A month that is missing sorts first and is the previous row of the first real month.
    months = rows_of(spark, settings, "gold", "receita_mensal", F.col("mes").asc_nulls_first())
    assert months[0] == (None, None, Decimal("1.00"), 1, None)
    assert months[1][0] == "2017-11" and months[1][4] is None


def test_gold_tables(spark, clean_run):
    settings, _ = clean_run
    money = Decimal
    assert rows_of(spark, settings, "gold", "receita_mensal", "mes") == [
        ("2017-11", money("40.00"), money("4.00"), 1, None),
        ("2017-12", money("0.00"), money("1.00"), 1, money("-100.00")),
        # The previous month has no revenue, then there is a gap of a month.
        ("2018-01", money("33.01"), money("4.00"), 2, None),
        ("2018-03", money("67.00"), money("3.00"), 3, money("102.97")),
    ]
    assert rows_of(spark, settings, "gold", "receita_por_estado", "estado") == [
        ("RJ", money("40.00"), 1, money("20.00")),
        ("SP", money("100.01"), 6, money("12.50")),
    ]
    assert rows_of(spark, settings, "gold", "performance_entrega_mensal", "mes") == [
        ("2017-11", 7.0, 100.0, 1, 0.0),
        ("2017-12", 1.0, 100.0, 1, 0.0),
        # One order has no estimate: it counts for the days but not for the percentage.
        ("2018-01", 16.5, 0.0, 2, 100.0),
    ]
    assert rows_of(spark, settings, "gold", "satisfacao_entrega", "status_entrega") == [
        ("atrasado", 1.5, 2),
        ("no_prazo", 4.5, 2),
    ]
    # Order o1 has two items and two reviews: its prices count twice, its scores twice each.
    assert rows_of(spark, settings, "gold", "ranking_vendedores", "seller_id") == [
        ("s5", "PR", money("151.01"), 5, 3.5),
    ]


def test_gold_schemas(spark, clean_run):
    settings, _ = clean_run
    types = {
        t: [f.dataType.simpleString() for f in read_table(spark, settings, "gold", t).schema]
        for t in (
            "receita_mensal",
            "receita_por_estado",
            "performance_entrega_mensal",
            "satisfacao_entrega",
            "ranking_vendedores",
        )
    }
    assert types == {
        "receita_mensal": ["string", "decimal(20,2)", "decimal(20,2)", "bigint", "decimal(28,2)"],
        "receita_por_estado": ["string", "decimal(20,2)", "bigint", "decimal(11,2)"],
        "performance_entrega_mensal": ["string", "double", "double", "bigint", "double"],
        "satisfacao_entrega": ["string", "double", "bigint"],
        "ranking_vendedores": ["string", "string", "decimal(20,2)", "bigint", "double"],
    }


def test_log_holds_one_batch_per_layer(spark, clean_run):
    settings, run_id = clean_run
    log = spark.table(settings.log_table)
    assert log.columns == ["camada", "tabela", "checagem", "status", "detalhe", "timestamp", "run_id", "lote"]
    counts = {r.camada: r["count"] for r in log.filter(F.col("run_id") == run_id).groupBy("camada").count().collect()}
    assert counts == {"bronze": 9, "silver": 13, "gold": 10}
    assert log.filter("status = 'FALHOU'").count() == 0
    assert [tuple(r) for r in log_summary(log, "silver").collect()][:2] == [
        ("category_translation", "PASSOU", 1),
        ("customers", "PASSOU", 1),
    ]


def test_a_repeated_run_has_one_set_of_verdicts(spark, tmp_path):
    write_landing(tmp_path, dirty=False)
    settings = make_settings(tmp_path, "twice")
    for _ in range(2):
        run_all(spark, settings, gate_layers=(), run_id="same id's")
        for status in ("FALHOU", "PASSOU"):
            record_check(spark, settings, "silver", "orders", "by hand", status, run_id="same id's")
            record_check(spark, settings, "silver", "orders", "by hand", status)
    log = spark.table(settings.log_table)
    counts = {(r.run_id, r.camada): r["count"] for r in log.groupBy("run_id", "camada").count().collect()}
    assert counts == {("same id's", "bronze"): 9, ("same id's", "silver"): 14, ("same id's", "gold"): 10, ("-", "silver"): 1}
    enforce(log, "silver", "same id's")
    enforce(log, "silver", "")


def test_gold_run_replaces_tables_and_presents_them_sorted(spark, clean_run):
    settings, _ = clean_run
    shown = run_gold(spark, settings, "again", review_grain="order")
    assert [r.estado for r in shown["receita_por_estado"].collect()] == ["SP", "RJ"]
    assert [r.receita_total for r in shown["ranking_vendedores"].collect()] == [Decimal("111.01")]
    run_gold(spark, settings, "restore")


def test_record_check_feeds_the_gate(spark, tmp_path):
    settings = make_settings(tmp_path, "single")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {settings.gold}")
    record_check(spark, settings, "silver", "orders", "manual", "PASSOU", run_id="m")
    enforce(spark.table(settings.log_table))
    record_check(spark, settings, "silver", "orders", "manual", "FALHOU", "by hand", "m")
    with pytest.raises(QualityGateError, match="layer 'silver'"):
        enforce(spark.table(settings.log_table), "silver")
    enforce(spark.table(settings.log_table), "gold")
    with pytest.raises(QualityGateError, match="no verdicts"):
        enforce(spark.table(settings.log_table), "gold", "m")


def test_lost_rows_fail_the_row_count(spark, tmp_path):
    write_landing(tmp_path, dirty=False)
    settings = make_settings(tmp_path, "lost")
    run_bronze(spark, settings, "a", gate=True)
    kept = read_table(spark, settings, "bronze", "customers").limit(2).collect()
    schema = read_table(spark, settings, "bronze", "customers").schema
    overwrite_table(spark.createDataFrame(kept, schema), settings, "bronze", "customers")
    failed = bronze_checks(spark, settings).filter("status = 'FALHOU'").collect()
    assert [r.tabela for r in failed] == ["customers"]


def test_runs_do_not_depend_on_the_session(spark, tmp_path, clean_run):
    expected, _ = clean_run
    write_landing(tmp_path, dirty=False)
    settings = make_settings(tmp_path, "session")
    own = {"spark.sql.ansi.enabled": "false", "spark.sql.session.timeZone": "America/Sao_Paulo"}
    before = {key: spark.conf.get(key) for key in own}
    try:
        for key, value in own.items():
            spark.conf.set(key, value)
        run_all(spark, settings)
        assert {key: spark.conf.get(key) for key in own} == own
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    for name, (column, _) in {n: o[0] for n, o in PRESENTATION.items()}.items():
        assert rows_of(spark, settings, "gold", name, column) == rows_of(spark, expected, "gold", name, column)


def test_a_pinned_sum_overflows_loudly(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pinned(spark), pytest.raises(Exception, match="overflow"):
            spark.range(2).selectExpr("sum(9223372036854775807 + id - id)").collect()
        assert spark.conf.get("spark.sql.ansi.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_a_failed_gate_leaves_the_former_tables(spark, tmp_path):
    write_landing(tmp_path, dirty=False)
    settings = make_settings(tmp_path, "gate")
    run_all(spark, settings)
    former = rows_of(spark, settings, "gold", "receita_mensal", "mes")
    items = read_table(spark, settings, "silver", "order_items")
    orphan = items.limit(1).withColumn("order_id", F.lit("nowhere"))
    overwrite_table(stage(items.union(orphan), settings, "more", "x"), settings, "silver", "order_items")
    drop_tables(spark, settings, "gold", ["more"], "x")
    with pytest.raises(QualityGateError):
        run_gold(spark, settings, "bad")
    assert rows_of(spark, settings, "gold", "receita_mensal", "mes") == former
    assert not [t.name for t in spark.catalog.listTables(settings.gold) if "__" in t.name]


def test_runs_stage_apart_from_each_other(spark, tmp_path):
    settings = make_settings(tmp_path, "apart")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {settings.gold}")
    first = stage(spark.range(3).toDF("n"), settings, "numbers", "run-1")
    second = stage(spark.range(5).toDF("n"), settings, "numbers", "run-2")
    assert (first.count(), second.count()) == (3, 5)
    overwrite_table(second, settings, "gold", "numbers")
    for run_id in ("run-1", "run-2"):
        drop_tables(spark, settings, "gold", ["numbers"], run_id)
    assert [t.name for t in spark.catalog.listTables(settings.gold)] == ["numbers"]
    assert read_table(spark, settings, "gold", "numbers").count() == 5


def test_command_line_runs_layer_by_layer(spark, tmp_path, capsys):
    write_landing(tmp_path, dirty=False)
    options = ["--raw-path", str(tmp_path), "--file-prefix", PREFIX]
    for layer in ("bronze", "silver", "gold"):
        main([layer, *options])
    shown = capsys.readouterr().out
    assert "bronze.reviews: 5 rows" in shown
    assert "payment_value" in shown and "category_translation" in shown
    assert spark.table("gold.receita_mensal").count() == 4


def test_command_line_of_a_full_run_and_profile(spark, tmp_path, capsys):
    write_landing(tmp_path, dirty=False)
    options = ["--raw-path", str(tmp_path), "--file-prefix", PREFIX, "--run-id", "cli", "--gate", "silver,gold"]
    main(["all", *options, "--observed-count", "--review-grain", "order", "--min-orders", "1"])
    shown = capsys.readouterr().out
    assert "run cli" in shown and "bronze.reviews: 5 rows" in shown and "payment_value" in shown
    assert spark.table("gold.ranking_vendedores").count() > 1
    main(["profile"])
    shown = capsys.readouterr().out
    assert "pct_nulos" in shown and "PASSOU" in shown
    with pytest.raises(SystemExit):
        main(["gold", "--gate", "lead"])
