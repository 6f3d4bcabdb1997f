"""Text normalisation and defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fold_lower(name: str) -> Column:
    """Spaces cut at both ends (tabs stay), then lower case."""
    return F.lower(F.trim(F.col(name)))


def fold_upper(name: str) -> Column:
    """Spaces cut at both ends (tabs stay), then upper case; accents are kept."""
    return F.upper(F.trim(F.col(name)))


def or_default(name: str, default: str) -> Column:
    """The column, or `default` where it is NULL. An empty or blank text is not NULL."""
    return F.coalesce(F.col(name), F.lit(default))


def quoted(name: str) -> str:
    """A column name as an identifier in an SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A text as a literal in an SQL expression."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
