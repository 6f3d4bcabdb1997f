"""Deduplication that keeps the same row on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_row_in_key"


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the smallest under `order`, by default all other columns left to right.

    A missing value comes after every present one, so of two copies the fuller one tends to stay.
    NULL is a key value like any other. The filter on the first row number lets Spark cut every
    key to one row per map task before the shuffle, so a key that holds a large share of the
    table reaches the reducer as one row per task.
    """
    ranking = list(order or [c for c in df.columns if c not in key]) or list(key)
    window = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_last() for c in ranking])
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def key_counts(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: all rows and distinct keys, NULL counting as one key value.

    Grouping first combines equal keys on the map side and answers both counts in one pass.
    """
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(
            F.coalesce(F.sum("copies"), F.lit(0)).alias("linhas"),
            F.count(F.lit(1)).alias("chaves"),
        )
    )


def dedup_report(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """One row: how many rows deduplication by `key` removes."""
    return key_counts(df, key).select(
        F.lit(table).alias("tabela"),
        F.lit(",".join(key)).alias("chave"),
        "linhas",
        "chaves",
        (F.col("linhas") - F.col("chaves")).alias("removidas"),
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct combinations of the columns; NULL counts as a value."""
    return df.select(*columns).distinct()
