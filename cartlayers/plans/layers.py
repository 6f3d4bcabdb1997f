"""Runs of the three layers: read, build, store, check."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cartlayers.operators.checks import enforce, log_summary, log_verdicts, row_count_match
from cartlayers.operators.combine import union_all
from cartlayers.operators.fingerprint import content
from cartlayers.operators.profile import null_profile
from cartlayers.operators.rules import inconsistent_date_count, outside_range_count
from cartlayers.operators.typing import cast_failures, lost_values
from cartlayers.plans import gold as g
from cartlayers.plans.silver import clean_all, silver_checks
from cartlayers.registry import TABLES, TableSpec
from cartlayers.session import pinned
from cartlayers.settings import Settings
from cartlayers.sources.landing import read_landing, with_audit, without_audit
from cartlayers.sources.tables import (
    Pending,
    create_databases,
    drop_tables,
    read_table,
    read_tables,
    stage,
    table_notes,
)


#: Table of the cleaned layer with the raw values that could not be typed.
QUARANTINE = "quarentena"


def new_run_id() -> str:
    return uuid.uuid4().hex


def ingest(spark: SparkSession, settings: Settings, spec: TableSpec, pending: Pending) -> int:
    """Store one landing file as a raw table of the run and return how many rows were read from it.

    Rows and content are observed while the rows are written, so the text is parsed once, and noted with
    the table. The write is a single stage without a shuffle, whose tasks report once however often they
    run.
    """
    source = read_landing(spark, settings.landing_path(spec.file), spec.reader)
    seen = Observation()
    counted = source.observe(seen, F.count(F.lit(1)).alias("rows"), content(source.columns).alias("content"))
    audited = with_audit(counted, settings.landing_file(spec.file))
    pending.write(spec.name, audited, lambda: {"rows": seen.get["rows"], "content": str(seen.get["content"])})
    return seen.get["rows"]


def run_bronze(
    spark: SparkSession,
    settings: Settings,
    run_id: str | None = None,
    recount_source: bool = True,
    gate: bool = False,
) -> dict[str, int]:
    """Ingest every declared table, log one row-count check each and return the rows read.

    The source is parsed a second time for a count that is independent of the write, so rows lost in
    reading are seen. `recount_source=False` saves that pass and compares with the rows observed while
    they were written.
    """
    run_id = run_id or new_run_id()
    with pinned(spark):
        create_databases(spark, settings)
        with Pending(spark, settings, "bronze", run_id) as pending:
            rows = {name: ingest(spark, settings, spec, pending) for name, spec in TABLES.items()}
            pending.publish()
        log_verdicts(bronze_checks(spark, settings, None if recount_source else rows), settings, run_id, "bronze")
        if gate:
            enforce(spark.table(settings.log_table), "bronze", run_id)
    return rows


def bronze_checks(
    spark: SparkSession, settings: Settings, observed: dict[str, int] | None = None
) -> DataFrame:
    """Rows of every stored table against its landing file, or against counts already known.

    Where the fingerprint of the landed rows was noted when they were written, the stored rows must have it.
    """
    verdicts = []
    loaded = read_tables(spark, settings, "bronze", TABLES)
    for name, spec in TABLES.items():
        source = observed[name] if observed else None
        if source is None:
            source = read_landing(spark, settings.landing_path(spec.file), spec.reader)
        noted = table_notes(spark, settings, "bronze", name).get("content")
        stored = without_audit(loaded[name])
        verdicts.append(row_count_match(source, stored, "bronze", name, Decimal(noted) if noted else None))
    return union_all(verdicts)


def typing_report(raw: dict[str, DataFrame]) -> DataFrame:
    """Values lost by typing, per column of every table with typed columns."""
    return union_all(
        [cast_failures(raw[name], name, spec.types) for name, spec in TABLES.items() if spec.types]
    )


def quarantine(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Every raw value that typing loses, with its table, key and column."""
    return union_all(
        [lost_values(raw[name], name, spec.types, spec.naming) for name, spec in TABLES.items() if spec.types]
    )


def quarantine_report(quarantined: DataFrame) -> DataFrame:
    """`typing_report` from the quarantined values: few rows to read instead of all raw tables."""
    declared = [(n, c, k) for n, spec in TABLES.items() for c, k in spec.types.items()]
    every = quarantined.sparkSession.createDataFrame(declared, "tabela string, coluna string, tipo string")
    counts = quarantined.groupBy("tabela", "coluna").agg(F.count(F.lit(1)).alias("falhas"))
    return every.join(counts, ["tabela", "coluna"], "left").select(
        "tabela", "coluna", "tipo", F.coalesce("falhas", F.lit(0)).alias("falhas")
    )


def dedup_summary(raw: dict[str, DataFrame], stored: dict[str, DataFrame]) -> DataFrame:
    """Rows before and after cleaning of every deduplicated table: removed copies and dropped rows.

    Counts of whole tables come from stored ones, whose file footers hold them. Dropped are keys that
    lack a required column, of which deduplication had left one row each.
    """
    parts = []
    for name, spec in TABLES.items():
        if spec.dedup_key:
            none = {"antes": F.lit(0), "depois": F.lit(0), "descartadas": F.lit(0)}
            counted = F.count(F.lit(1))
            parts += [
                _counts(raw[name], name, none | {"antes": counted}),
                _counts(stored[name], name, none | {"depois": counted}),
            ]
            if spec.required:
                lacking = reduce(or_, [F.col(c).isNull() for c in spec.required])
                keys = raw[name].filter(lacking).select(*spec.dedup_key).distinct()
                parts.append(_counts(keys, name, none | {"descartadas": counted}))
    columns = ["antes", "depois", "descartadas"]
    return (
        union_all(parts)
        .groupBy("tabela")
        .agg(*[F.max(c).alias(c) for c in columns])
        .withColumn("removidas", F.col("antes") - F.col("depois") - F.col("descartadas"))
    )


def _counts(df: DataFrame, name: str, measures: dict[str, Column]) -> DataFrame:
    counts = df.agg(*[m.cast("bigint").alias(c) for c, m in measures.items()])
    return counts.select(F.lit(name).alias("tabela"), *measures)


@dataclass(frozen=True)
class CleaningReport:
    """What cleaning changed: a row per typed column, and a row per deduplicated table."""

    typing: DataFrame
    removed: DataFrame


def _fetched(report: DataFrame) -> DataFrame:
    """A report of a few rows, computed now and under the settings of the run."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


def run_silver(
    spark: SparkSession, settings: Settings, run_id: str | None = None, gate: bool = False
) -> CleaningReport:
    """Clean and store every table, log the key and reference checks, report the changes.

    All tables become visible together, once they are checked; a gated run that fails changes none. The
    values that typing lost are a table beside them, from which the report counts them.
    """
    run_id = run_id or new_run_id()
    with pinned(spark):
        create_databases(spark, settings)
        raw = read_tables(spark, settings, "bronze", TABLES)
        with Pending(spark, settings, "silver", run_id) as pending:
            stored = {name: pending.write(name, df) for name, df in clean_all(raw).items()}
            log_verdicts(silver_checks(stored), settings, run_id, "silver")
            lost = pending.write(QUARANTINE, quarantine(raw))
            report = CleaningReport(_fetched(quarantine_report(lost)), _fetched(dedup_summary(raw, stored)))
            if gate:
                enforce(spark.table(settings.log_table), "silver", run_id)
            pending.publish()
    return report


def run_gold(
    spark: SparkSession,
    settings: Settings,
    run_id: str | None = None,
    gate: bool = True,
    review_grain: str = "row",
    min_orders: int = g.MIN_ORDERS,
) -> dict[str, DataFrame]:
    """Build the business tables, log their checks, stop when one failed, publish the tables.

    Readers see all new tables at once or, when a gated run fails or breaks off, none; no run leaves its
    own behind.
    """
    run_id = run_id or new_run_id()
    with pinned(spark):
        create_databases(spark, settings)
        silver = read_tables(spark, settings, "silver", TABLES)
        orders, items, reviews = silver["orders"], silver["order_items"], silver["reviews"]
        with Pending(spark, settings, "gold", run_id) as pending:
            try:
                # Two business tables start from the join of orders and items; it is computed once.
                sales = stage(g.order_sales(orders, items), settings, "order_sales", run_id)
                delivered = g.delivered_orders(orders)
                tables = {
                    "receita_mensal": g.monthly_revenue_of(sales),
                    "receita_por_estado": g.revenue_by_state_of(sales, silver["customers"]),
                    "performance_entrega_mensal": g.delivery_performance(delivered),
                    "satisfacao_entrega": g.delivery_satisfaction(delivered, reviews),
                    "ranking_vendedores": g.seller_ranking(
                        items, orders, silver["sellers"], reviews, min_orders, review_grain
                    ),
                }
                own = {name: pending.write(name, df) for name, df in tables.items()}
            finally:
                drop_tables(spark, settings, "gold", ["order_sales"], run_id)
            log_verdicts(g.gold_checks(own, items, min_orders), settings, run_id, "gold")
            if gate:
                enforce(spark.table(settings.log_table), "gold", run_id)
            pending.publish()
    return {name: g.present(name, df) for name, df in read_tables(spark, settings, "gold", tables).items()}


@dataclass(frozen=True)
class RunReport:
    """What a full run did."""

    run_id: str
    rows: dict[str, int]
    cleaning: CleaningReport
    gold: dict[str, DataFrame]


def run_all(
    spark: SparkSession,
    settings: Settings,
    gate_layers: tuple[str, ...] = ("gold",),
    run_id: str | None = None,
    recount_source: bool = True,
    review_grain: str = "row",
    min_orders: int = g.MIN_ORDERS,
) -> RunReport:
    """All three layers under one run id."""
    run_id = run_id or new_run_id()
    rows = run_bronze(spark, settings, run_id, recount_source, gate="bronze" in gate_layers)
    cleaning = run_silver(spark, settings, run_id, gate="silver" in gate_layers)
    gold = run_gold(spark, settings, run_id, "gold" in gate_layers, review_grain, min_orders)
    return RunReport(run_id, rows, cleaning, gold)


@dataclass(frozen=True)
class Profile:
    """Diagnostics of stored tables, computed when they are looked at."""

    nulls: dict[str, DataFrame]
    scores_outside: DataFrame
    inconsistent_dates: DataFrame
    log: DataFrame


def profile(spark: SparkSession, settings: Settings, layer: str = "silver") -> Profile:
    """Missing values per raw column, scores outside their domain, inconsistent dates, the log's summary."""
    reviews = read_table(spark, settings, "silver", "reviews")
    orders = read_table(spark, settings, "silver", "orders")
    return Profile(
        {n: null_profile(df, n) for n, df in read_tables(spark, settings, "bronze", TABLES).items()},
        outside_range_count(reviews, "review_score", 1, 5),
        inconsistent_date_count(orders),
        log_summary(spark.table(settings.log_table), layer),
    )
