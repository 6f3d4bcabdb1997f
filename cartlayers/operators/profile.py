"""Profile of tables: type and share of missing values per column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlayers.functions.text import literal, quoted
from cartlayers.operators.combine import union_all


def _profile_rows(df: DataFrame, table: str) -> DataFrame:
    fields = [(i, f) for i, f in enumerate(df.schema.fields, start=1) if not f.name.startswith("_")]
    missing = [
        f"count_if({quoted(f.name)} IS NULL OR CAST({quoted(f.name)} AS STRING) = '') AS missing_{i}"
        for i, f in fields
    ]
    rows = ", ".join(
        f"{literal(table)}, {i}, {literal(f.name)}, {literal(f.dataType.simpleString())}, "
        f"round(try_divide(missing_{i}, total) * 100, 2)"
        for i, f in fields
    )
    return df.selectExpr("count(*) AS total", *missing).selectExpr(
        f"stack({len(fields)}, {rows}) AS (tabela, posicao, campo, tipo, pct_nulos)"
    )


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and data column: position, type and percentage of NULL or empty values.

    Columns whose name starts with an underscore are audit columns and are left out. Each table is
    profiled in one aggregate over one scan; an empty table has NULL percentages.
    """
    profiles = union_all([_profile_rows(df, name) for name, df in tables.items()])
    return profiles.orderBy("tabela", F.desc("pct_nulos"), "posicao")


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """The profile of a single table, columns with the most missing values first."""
    return profile_tables({table: df})
