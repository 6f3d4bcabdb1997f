"""Fingerprints of tables that do not depend on the order or place of their rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str]) -> Column:
    """64 bits of a row. Every column's place is hashed too, since the hash passes over missing values."""
    numbered = [part for i, c in enumerate(columns) for part in (F.lit(i), F.col(c))]
    return F.xxhash64(*numbered)


def content(columns: Sequence[str]) -> Column:
    """Aggregate: the sum of the row hashes, so that every copy of a row counts.

    A sum of a quintillion rows fits. Like any sum it is the same however often a task is run, and it
    combines on the map side to one number per task.
    """
    return F.coalesce(F.sum(row_hash(columns).cast("decimal(20,0)")), F.lit(0)).cast("decimal(38,0)")


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row: `linhas` and `conteudo`, of the given columns or all."""
    return df.agg(F.count(F.lit(1)).alias("linhas"), content(columns or df.columns).alias("conteudo"))
