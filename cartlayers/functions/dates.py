"""Calendar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(name: str) -> Column:
    """First day of the month as a DATE: a four-byte grouping key, cheaper per row than a label."""
    return F.trunc(F.col(name), "MM")


def month_label(name: str) -> Column:
    """`yyyy-MM` text of a date or timestamp."""
    return F.date_format(F.col(name), "yyyy-MM")


def days_between(start: str, end: str) -> Column:
    """Calendar days from `start` to `end`; the time of day does not count."""
    return F.datediff(F.col(end), F.col(start))
