"""Landing files: delimited text with a header, read without inference."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INGEST_TIME = "_ingest_timestamp"
SOURCE_FILE = "_source_file"
AUDIT_COLUMNS = (INGEST_TIME, SOURCE_FILE)


def read_landing(spark: SparkSession, path: str, options: Mapping[str, str] | None = None) -> DataFrame:
    """Scan a CSV file, folder or glob. Names come from the header and every field stays text.

    Files read with `multiLine` cannot be split, so Spark gives each one a single task. Large
    data sets of that kind should land as many files below one folder.
    """
    return spark.read.option("header", True).options(**(options or {})).csv(path)


def with_audit(df: DataFrame, file: str) -> DataFrame:
    """Add the time of ingestion and the literal name of the source file."""
    return df.withColumns({INGEST_TIME: F.current_timestamp(), SOURCE_FILE: F.lit(file)})


def without_audit(df: DataFrame) -> DataFrame:
    """Drop the audit columns, which would be ambiguous after a join of two stored tables."""
    return df.drop(*AUDIT_COLUMNS)
