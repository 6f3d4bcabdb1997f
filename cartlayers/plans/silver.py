"""Cleaned tables, built from the declarations in the registry."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlayers.functions.text import fold_lower, fold_upper
from cartlayers.operators.checks import KeyCheck, key_verdicts
from cartlayers.operators.combine import union_all
from cartlayers.operators.dedup import keep_first
from cartlayers.operators.rules import (
    fill_defaults,
    flag_inconsistent_dates,
    normalize_text,
    require,
)
from cartlayers.operators.typing import apply_types
from cartlayers.registry import TABLES, TableSpec


def before_dedup(spec: TableSpec, raw: DataFrame) -> DataFrame:
    """Typed rows, in the form in which copies are compared."""
    df = apply_types(raw, spec.types)
    return normalize_text(df, spec.lower, spec.upper) if spec.text_first else df


def after_dedup(spec: TableSpec, kept: DataFrame) -> DataFrame:
    """The cleaned table from the rows that were kept, row by row."""
    df = fill_defaults(require(kept, spec.required), spec.defaults)
    if not spec.text_first:
        df = normalize_text(df, spec.lower, spec.upper)
    return flag_inconsistent_dates(df) if spec.dated else df


def changes_kept_rows(spec: TableSpec) -> bool:
    """Whether `after_dedup` does anything for a table."""
    folded = not spec.text_first and (spec.lower or spec.upper)
    return bool(spec.required or spec.defaults or spec.dated or folded)


def clean(spec: TableSpec, raw: DataFrame) -> DataFrame:
    """The cleaned table of one declaration, from its raw all-text table."""
    if spec.points:
        return centroids(apply_types(raw, spec.types))
    df = before_dedup(spec, raw)
    if spec.dedup_key:
        df = keep_first(df, spec.dedup_key, spec.dedup_order)
    return after_dedup(spec, df)


def row_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Per raw table its rows (`origem`) and those that its cleaned table has (`gravado`), without cleaning it.

    All tables emit their keys into one grouping, which combines copies on the map side; a key is a row
    of the cleaned table unless a required column is missing in it. Required columns are part of the key.
    """
    keys = []
    for name, df in raw.items():
        spec = TABLES[name]
        key = (spec.unique,) if spec.points else spec.dedup_key
        rows = df if spec.points else before_dedup(spec, df)
        kept = reduce(and_, [F.col(c).isNotNull() for c in spec.required], F.lit(True))
        texts = F.array(*[F.col(c).cast("string") for c in key]).cast("array<string>")
        keys.append(
            rows.select(F.lit(name).alias("tabela"), texts.alias("key"), kept.alias("kept"), F.lit(bool(key)).alias("once"))
        )
    copies = union_all(keys).groupBy("tabela", "key", "kept", "once").agg(F.count(F.lit(1)).alias("copies"))
    left = F.when(F.col("once"), F.col("kept").cast("bigint")).otherwise(F.col("copies"))
    counts = copies.groupBy("tabela").agg(F.sum("copies").alias("origem"), F.sum(left).alias("gravado"))
    # a table without rows has its verdict, too
    names = next(iter(raw.values())).sparkSession.createDataFrame([(n,) for n in raw], "tabela string")
    zeros = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("origem", "gravado")}
    return names.join(counts, "tabela", "left").withColumns(zeros)


def centroids(points: DataFrame) -> DataFrame:
    """Mean position and one place name per zip code prefix.

    Points are totalled per prefix and place name first, which combines equal names on the map side;
    the second grouping gets one row per prefix and name. The name kept is a pair of city and state
    found together: a complete pair before others, then the most frequent, then the smallest.
    """
    prefix = "geolocation_zip_code_prefix"
    per_place = points.groupBy(prefix, "geolocation_city", "geolocation_state").agg(
        F.sum("geolocation_lat").alias("lat_sum"),
        F.count("geolocation_lat").alias("lat_n"),
        F.sum("geolocation_lng").alias("lng_sum"),
        F.count("geolocation_lng").alias("lng_n"),
        F.count(F.lit(1)).alias("points"),
    )
    place = F.struct(
        F.col("geolocation_city").isNull() | F.col("geolocation_state").isNull(),
        -F.col("points"),
        F.col("geolocation_city").isNull(),
        F.col("geolocation_city").alias("city"),
        F.col("geolocation_state").isNull(),
        F.col("geolocation_state").alias("state"),
    )
    return (
        per_place.groupBy(prefix)
        .agg(
            F.try_divide(F.sum("lat_sum"), F.sum("lat_n")).alias("latitude"),
            F.try_divide(F.sum("lng_sum"), F.sum("lng_n")).alias("longitude"),
            F.min(place).alias("place"),
        )
        .select(
            prefix,
            "latitude",
            "longitude",
            F.col("place.city").alias("cidade"),
            F.col("place.state").alias("estado"),
        )
        .withColumns({"cidade": fold_lower("cidade"), "estado": fold_upper("estado")})
    )


def clean_all(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: clean(spec, raw[name]) for name, spec in TABLES.items()}


def silver_checks(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Key and reference verdicts of all cleaned tables, each of which is read once."""
    unique = [KeyCheck(s.name, s.unique, s.name, s.unique) for s in TABLES.values() if s.unique]
    references = [
        KeyCheck(s.name, fk.column, fk.parent, fk.parent_key) for s in TABLES.values() for fk in s.parents
    ]
    return key_verdicts(tables, "silver", unique, references)
