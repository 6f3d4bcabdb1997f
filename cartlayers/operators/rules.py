"""Row rules of the cleaned layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlayers.functions.text import fold_lower, fold_upper, or_default

FLAG = "flag_data_inconsistente"


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which any of the columns is NULL."""
    return df.dropna(subset=list(columns)) if columns else df


def fill_defaults(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    return df.withColumns({name: or_default(name, text) for name, text in defaults.items()})


def normalize_text(df: DataFrame, lower: Sequence[str] = (), upper: Sequence[str] = ()) -> DataFrame:
    """Trim and case-fold the listed columns so that equal names group together."""
    return df.withColumns(
        {**{c: fold_lower(c) for c in lower}, **{c: fold_upper(c) for c in upper}}
    )


def flag_inconsistent_dates(orders: DataFrame) -> DataFrame:
    """Mark orders delivered before they were bought; a missing date is not an inconsistency."""
    early = F.col("order_delivered_customer_date") < F.col("order_purchase_timestamp")
    return orders.withColumn(FLAG, F.coalesce(early, F.lit(False)))


def inconsistent_date_count(orders: DataFrame) -> DataFrame:
    return orders.agg(F.count_if(F.col(FLAG)).alias("qtd_inconsistentes"))


def outside_range(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Rows whose value lies outside the closed range; a missing value is not returned."""
    return df.filter(~F.col(column).between(low, high))


def outside_range_count(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    return df.agg(F.count_if(~F.col(column).between(low, high)).alias("qtd_fora_do_dominio"))
