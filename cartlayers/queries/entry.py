"""What a registered query is: a function of the views and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlayers.queries.views import Views
from cartlayers.session import pin_semantics


@dataclass(frozen=True)
class Query:
    build: Callable[[Views], DataFrame]
    sql: str

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        """The lazy result. The session keeps the pinned settings, which the rows depend on."""
        return plain(self.build(Views(pin_semantics(spark), folder)))


def plain(df: DataFrame) -> DataFrame:
    """Types that both engines share: decimals as doubles, timestamps without a zone."""
    casts = {T.DecimalType: "double", T.TimestampType: "timestamp_ntz"}
    changed = {
        field.name: F.col(field.name).cast(casts[type(field.dataType)])
        for field in df.schema.fields
        if type(field.dataType) in casts
    }
    return df.withColumns(changed) if changed else df
