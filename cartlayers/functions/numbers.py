"""Ratios and rounding. Every division yields NULL instead of failing on a zero divisor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cents(name: str) -> Column:
    """A money column as a whole number of cents.

    A sum of cents is one eight-byte number while it is shuffled, a sum of decimals four times
    that. It holds 92 quadrillion units per group, about a tenth of what decimal(20,2) holds, and
    ANSI arithmetic stops the job beyond it. Use it for the first grouping and `cents_total` above.
    """
    return (F.col(name).cast("decimal(10,2)") * 100).cast("bigint")


def cents_total(total: Column) -> Column:
    """Money as decimal(20,2) from a sum over `wide` cents."""
    return (total * F.lit("0.01").cast("decimal(2,2)")).cast("decimal(20,2)")


def wide(total: Column) -> Column:
    """Cents of a group as a decimal, for sums over groups and products with counts."""
    return total.cast("decimal(20,0)")


def percent_change(current: Column, previous: Column) -> Column:
    """Change against `previous` in percent, two decimals; NULL when there is none or it is zero."""
    return F.round(F.try_divide(current - previous, previous) * 100, 2)


def mean_of_totals(total: Column, rows: Column) -> Column:
    """Mean from an integer total and a row count, two decimals; NULL without rows."""
    return F.round(F.try_divide(total, rows), 2)


def money_mean(total: Column, rows: Column) -> Column:
    """Mean of money values from their total and count, with the type and rounding of AVG.

    AVG over decimal(10,2) has six decimals, so the quotient goes through six before two.
    """
    mean = F.try_divide(total.cast("decimal(20,2)"), rows.cast("decimal(20,0)"))
    return F.round(mean.cast("decimal(14,6)"), 2)
