"""Safe typing of text columns and accounting of what could not be typed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlayers.functions.text import literal, quoted


def apply_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the listed columns; a value that does not fit its type becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def cast_failures(df: DataFrame, table: str, types: Mapping[str, str]) -> DataFrame:
    """Per listed column, how many non-NULL values the cast turns into NULL.

    All columns are counted in one aggregate over one scan of just those columns; the one-row
    result is then turned into one row per column.
    """
    lost = [
        f"count_if({quoted(c)} IS NOT NULL AND try_cast({quoted(c)} AS {kind}) IS NULL) AS lost_{i}"
        for i, (c, kind) in enumerate(types.items())
    ]
    rows = ", ".join(
        f"{literal(table)}, {literal(c)}, {literal(kind)}, lost_{i}"
        for i, (c, kind) in enumerate(types.items())
    )
    return df.selectExpr(*lost).selectExpr(
        f"stack({len(types)}, {rows}) AS (tabela, coluna, tipo, falhas)"
    )


def lost_values(df: DataFrame, table: str, types: Mapping[str, str], key: Sequence[str]) -> DataFrame:
    """A row for every value that its cast turns into NULL: table, key (as JSON), column, type and raw value.

    One pass over the rows, nothing is shuffled. Counted per column it is what `cast_failures` says.
    """
    lost = [
        F.when(
            F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull(),
            F.struct(F.lit(c).alias("coluna"), F.lit(kind).alias("tipo"), F.col(c).cast("string").alias("valor")),
        )
        for c, kind in types.items()
    ]
    named = F.to_json(F.struct(*key), {"ignoreNullFields": "false"})
    found = df.select(named.alias("chave"), F.inline(F.array_compact(F.array(*lost))))
    return found.select(F.lit(table).alias("tabela"), "chave", "coluna", "tipo", "valor")
