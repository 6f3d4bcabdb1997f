"""Quality checks.

A check is a one-row (or few-row) DataFrame of verdicts, computed in Spark and not fetched to the
driver. A layer unions its verdicts and puts them into the log in one write.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlayers.operators.combine import union_all
from cartlayers.operators.dedup import key_counts
from cartlayers.operators.fingerprint import content
from cartlayers.operators.references import orphan_count
from cartlayers.settings import LOG_TABLE, Settings
from cartlayers.sources.tables import replace_batch

# The two states a check can have in the log.
PASSED = "PASSOU"
FAILED = "FALHOU"

#: Run of checks that were recorded outside of any.
NO_RUN = "-"

VERDICT_COLUMNS = ("camada", "tabela", "checagem", "status", "detalhe")


class QualityGateError(RuntimeError):
    """Raised when a gated layer has failed checks."""


def _entry(layer: str, table: str, check: str, ok: Column, detail: Column) -> Column:
    # A measure that is NULL proves nothing, so it fails.
    return F.struct(
        F.lit(layer).alias("camada"),
        F.lit(table).alias("tabela"),
        F.lit(check).alias("checagem"),
        F.when(ok, F.lit(PASSED)).otherwise(F.lit(FAILED)).alias("status"),
        detail.alias("detalhe"),
    )


def _verdict(
    measures: DataFrame, layer: str, table: str, check: str, ok: Column, detail: Column
) -> DataFrame:
    return measures.select(_entry(layer, table, check, ok, detail).alias("v")).select("v.*")


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit("None"))


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Put the columns of two one-row frames into one row without a join."""
    both = left.unionByName(right, allowMissingColumns=True)
    return both.agg(*[F.max(f"`{c}`").alias(c) for c in both.columns])


def row_count_match(
    source: DataFrame | int,
    stored: DataFrame,
    layer: str,
    table: str,
    written: Decimal | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The stored table has as many rows as its source; the source may be an already known count.

    With `written`, the fingerprint that the rows of the source had while they were written, the stored
    `columns` must have the same content, so a lost, doubled or changed cell fails as well.
    """
    measures = [F.count(F.lit(1)).alias("gravado")]
    if written is not None:
        measures.append(content(columns or stored.columns).alias("conteudo"))
    loaded = stored.agg(*measures)
    if isinstance(source, DataFrame):
        counts = _beside(source.agg(F.count(F.lit(1)).alias("origem")), loaded)
    else:
        counts = loaded.withColumn("origem", F.lit(source).cast("bigint"))
    same = F.lit(True) if written is None else F.col("conteudo") == F.lit(written).cast("decimal(38,0)")
    return _verdict(
        counts,
        layer,
        table,
        "contagem_linhas_vs_origem",
        (F.col("origem") == F.col("gravado")) & same,
        F.concat(
            F.lit("origem="), _text("origem"), F.lit(", gravado="), _text("gravado"),
            F.when(same, F.lit("")).otherwise(F.lit(", conteúdo diferente")),
        ),
    )


def row_count_verdicts(counts: DataFrame, layer: str) -> DataFrame:
    """Verdicts of `row_count_match` for many tables, from a row with `origem` and `gravado` for each."""
    return counts.select(
        F.lit(layer).alias("camada"),
        "tabela",
        F.lit("contagem_linhas_vs_origem").alias("checagem"),
        F.when(F.col("origem") == F.col("gravado"), F.lit(PASSED)).otherwise(F.lit(FAILED)).alias("status"),
        F.concat(F.lit("origem="), _text("origem"), F.lit(", gravado="), _text("gravado")).alias("detalhe"),
    )


def content_match(source: DataFrame, stored: DataFrame, layer: str, table: str) -> DataFrame:
    """Both frames hold the same rows equally often, compared by fingerprint: each is read once, nothing is joined."""
    names = source.columns
    both = _beside(
        source.agg(content(names).alias("origem"), F.count(F.lit(1)).alias("linhas_origem")),
        stored.agg(content(names).alias("gravado"), F.count(F.lit(1)).alias("linhas")),
    )
    same = (F.col("origem") == F.col("gravado")) & (F.col("linhas_origem") == F.col("linhas"))
    detail = F.concat(_text("linhas"), F.when(same, F.lit(" linhas iguais")).otherwise(F.lit(" linhas, conteúdo diferente")))
    return _verdict(both, layer, table, "conteudo_vs_origem", same, detail)


def unique_key(df: DataFrame, layer: str, table: str, column: str) -> DataFrame:
    """Every key value occurs once. One NULL key passes, two fail."""
    return _verdict(
        key_counts(df, [column]),
        layer,
        table,
        f"chave_unica_{column}",
        F.col("linhas") == F.col("chaves"),
        F.concat(_text("linhas"), F.lit(" vs "), _text("chaves")),
    )


def referential_integrity(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_key: str,
    layer: str,
    child_name: str,
    parent_name: str,
) -> DataFrame:
    """Every child row has its parent."""
    return _verdict(
        orphan_count(child, column, parent, parent_key),
        layer,
        child_name,
        f"integridade_{column}_para_{parent_name}",
        F.col("orfaos") == 0,
        F.concat(_text("orfaos"), F.lit(" órfãos")),
    )


@dataclass(frozen=True)
class KeyCheck:
    """`column` of `table` holds keys of the domain `parent.parent_key`; its own, if it is unique there."""

    table: str
    column: str
    parent: str
    parent_key: str


def key_verdicts(
    tables: Mapping[str, DataFrame],
    layer: str,
    unique: Sequence[KeyCheck],
    references: Sequence[KeyCheck],
) -> DataFrame:
    """Verdicts of `unique_key` and `referential_integrity` for many tables, without a join.

    Every table is read once and emits each of its keys with the domain it belongs to and which check
    it counts for. Grouped by domain and value, which combines on the map side, a value has its copies
    as a key and its rows per reference side by side. A missing key equals no other, so it is an
    orphan as a reference. The parent of a reference must be among the unique keys.
    """
    checks = [*unique, *references]
    emitted: dict[str, list[Column]] = {}
    for number, check in enumerate(checks):
        entry = F.struct(
            F.lit(f"{check.parent}.{check.parent_key}").alias("domain"),
            F.col(check.column).cast("string").alias("value"),
            F.lit(number).alias("check"),
        )
        emitted.setdefault(check.table, []).append(entry)
    keys = union_all([tables[t].select(F.inline(F.array(*entries))) for t, entries in emitted.items()])
    rows = [F.count_if(F.col("check") == n).alias(f"rows_{n}") for n in range(len(checks))]
    values = keys.groupBy("domain", "value").agg(*rows)
    measures = []
    for n, check in enumerate(unique):
        measures += [
            F.coalesce(F.sum(f"rows_{n}"), F.lit(0)).alias(f"a_{n}"),
            F.count_if(F.col(f"rows_{n}") > 0).alias(f"b_{n}"),
        ]
    owner = {(c.parent, c.parent_key): n for n, c in enumerate(unique)}
    for n, check in enumerate(references, start=len(unique)):
        copies = F.col(f"rows_{owner[check.parent, check.parent_key]}")
        alone = F.when(F.col("value").isNull() | (copies == 0), F.col(f"rows_{n}")).otherwise(0)
        measures.append(F.coalesce(F.sum(alone), F.lit(0)).alias(f"a_{n}"))
    verdicts = [
        _entry(
            layer,
            check.table,
            f"chave_unica_{check.column}",
            F.col(f"a_{n}") == F.col(f"b_{n}"),
            F.concat(_text(f"a_{n}"), F.lit(" vs "), _text(f"b_{n}")),
        )
        for n, check in enumerate(unique)
    ] + [
        _entry(
            layer,
            check.table,
            f"integridade_{check.column}_para_{check.parent}",
            F.col(f"a_{n}") == 0,
            F.concat(_text(f"a_{n}"), F.lit(" órfãos")),
        )
        for n, check in enumerate(references, start=len(unique))
    ]
    return values.agg(*measures).select(F.inline(F.array(*verdicts)))


def sum_reconciliation(
    gold: DataFrame,
    gold_column: str,
    silver: DataFrame,
    silver_column: str,
    layer: str,
    table: str,
    check: str = "reconciliacao_com_silver",
) -> DataFrame:
    """Totals of two layers differ by less than one cent, compared as decimals."""
    total = silver.agg(F.sum(silver_column).alias("silver"))
    return verdicts_of([sum_check(table, gold_column, "silver", check)], {table: gold}, layer, total)


@dataclass(frozen=True)
class RowRule:
    """A check that passes when no row satisfies `broken`; NULL does not break a rule."""

    check: str
    broken: Column
    noun: str


def negative(column: str) -> Column:
    return F.col(column) < 0


def missing(column: str) -> Column:
    return F.col(column).isNull()


def outside(column: str, low: int, high: int) -> Column:
    return (F.col(column) < low) | (F.col(column) > high)


def below(column: str, minimum: int) -> Column:
    return F.col(column) < minimum


@dataclass(frozen=True)
class Check:
    """A check as aggregates over one frame; `ok` and `detail` refer to the measures by their names."""

    table: str
    name: str
    measures: Mapping[str, Column]
    ok: Column
    detail: Column


def rule_check(table: str, rule: RowRule) -> Check:
    broken = f"{table}.{rule.check}"
    return Check(
        table,
        rule.check,
        {broken: F.count_if(rule.broken)},
        F.col(f"`{broken}`") == 0,
        F.concat(_text(f"`{broken}`"), F.lit(f" {rule.noun}")),
    )


def category_check(table: str, column: str, expected: Sequence[str]) -> Check:
    value, name = F.col(column), f"{table}.{column}"
    found = [f"{name}.{i}" for i in range(len(expected))]
    measures = {f: F.count_if(value == c) for f, c in zip(found, expected, strict=True)}
    measures[f"{name}.besides"] = F.count_if(value.isNull() | ~value.isin(*expected))
    besides = f"`{name}.besides`"
    there = [F.col(f"`{f}`") > 0 for f in found]
    listed = F.concat_ws(", ", *[F.when(t, F.lit(c)) for t, c in zip(there, expected, strict=True)])
    return Check(
        table,
        "categorias_esperadas",
        measures,
        reduce(lambda a, b: a & b, there, F.col(besides) == 0),
        F.concat(F.lit("["), listed, F.lit("] fora da lista: "), _text(besides)),
    )


def sum_check(table: str, column: str, other: str, name: str = "reconciliacao_com_silver") -> Check:
    """The sum of a column against the measure `other` of another frame."""
    total = f"{table}.{column}.sum"
    return Check(
        table,
        name,
        {total: F.sum(column)},
        F.abs(F.col(f"`{total}`") - F.col(f"`{other}`")) < F.lit("0.01").cast("decimal(3,2)"),
        F.concat(F.lit("gold="), _text(f"`{total}`"), F.lit(", silver="), _text(f"`{other}`")),
    )


def verdicts_of(
    checks: Sequence[Check], frames: Mapping[str, DataFrame], layer: str, *others: DataFrame
) -> DataFrame:
    """Verdicts of all checks: one aggregate per frame; `others` are one-row frames of further measures."""
    rows = list(others)
    for table in dict.fromkeys(c.table for c in checks):
        measures = {n: m for c in checks if c.table == table for n, m in c.measures.items()}
        if measures:
            rows.append(frames[table].agg(*[m.alias(n) for n, m in measures.items()]))
    together = reduce(_beside, rows)
    entries = [_entry(layer, c.table, c.name, c.ok, c.detail) for c in checks]
    return together.select(F.inline(F.array(*entries)))


def row_rules(df: DataFrame, layer: str, table: str, rules: Sequence[RowRule]) -> DataFrame:
    """Verdicts of all row rules of a table from a single aggregate."""
    return verdicts_of([rule_check(table, r) for r in rules], {table: df}, layer)


def category_set(
    df: DataFrame, column: str, expected: Sequence[str], layer: str, table: str
) -> DataFrame:
    """Exactly the expected categories occur: none missing, none besides, no NULL."""
    return verdicts_of([category_check(table, column, expected)], {table: df}, layer)


def stamp(verdicts: DataFrame, run_id: str) -> DataFrame:
    """Verdicts in the layout of the log."""
    return verdicts.select(
        *VERDICT_COLUMNS,
        F.current_timestamp().alias("timestamp"),
        F.lit(run_id or NO_RUN).alias("run_id"),
    )


def log_verdicts(
    verdicts: DataFrame, settings: Settings, run_id: str, layer: str, batch: str | None = None
) -> None:
    """Put the verdicts of a layer into the log as one small file.

    The log is partitioned by run and batch (the layer, unless named otherwise), and a batch is replaced as
    a whole: a run that is repeated under its id leaves one set of verdicts, not two.
    """
    replace_batch(
        stamp(verdicts, run_id).coalesce(1), settings, "gold", LOG_TABLE, run_id=run_id or NO_RUN, lote=batch or layer
    )


def record_check(
    spark: SparkSession,
    settings: Settings,
    layer: str,
    table: str,
    check: str,
    status: str,
    detail: str = "",
    run_id: str = "",
) -> None:
    """Log a single check whose outcome the caller already knows; a repetition replaces it."""
    row = spark.createDataFrame(
        [(layer, table, check, status, detail)], ", ".join(f"{c} string" for c in VERDICT_COLUMNS)
    )
    log_verdicts(row, settings, run_id, layer, f"{layer}/{table}/{check}")


def _log_rows(log: DataFrame, layer: str | None, run_id: str | None) -> DataFrame:
    if layer is not None:
        log = log.filter(F.col("camada") == layer)
    if run_id is not None:
        log = log.filter(F.col("run_id") == (run_id or NO_RUN))
    return log


def enforce(log: DataFrame, layer: str | None = None, run_id: str | None = None) -> None:
    """Stop the caller when the log holds a failed check.

    Without `run_id` the whole history counts, so one old failure keeps blocking. With one, a log
    without any verdict of it proves nothing and stops the caller as well.
    """
    rows = _log_rows(log, layer, run_id)
    checked, failed = rows.agg(F.count(F.lit(1)), F.count_if(F.col("status") == FAILED)).first()
    if run_id is not None and not checked:
        raise QualityGateError(f"run '{run_id}' has no verdicts in layer '{layer or 'all'}'")
    if failed:
        raise QualityGateError(f"{failed} quality check(s) failed in layer '{layer or 'all'}'")


def log_summary(log: DataFrame, layer: str) -> DataFrame:
    """Checks per table and status of one layer."""
    return (
        _log_rows(log, layer, None)
        .groupBy("tabela", "status")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("tabela", "status")
    )
