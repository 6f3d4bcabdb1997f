"""Spark session settings the engine relies on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results. They are pinned on whatever session is used.
SEMANTIC_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings that only change how a plan runs. Partition counts and memory stay with the cluster.
EXECUTION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the call site of every column expression costs several driver round trips each.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


@contextmanager
def pinned(spark: SparkSession) -> Iterator[SparkSession]:
    """Hold the result-changing settings during an eager run and give back the caller's values."""
    before = {key: spark.conf.get(key, None) for key in SEMANTIC_SETTINGS}
    pin_semantics(spark)
    try:
        yield spark
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def pin_semantics(spark: SparkSession) -> SparkSession:
    """Set the result-changing settings on an existing session and return it."""
    for key, value in SEMANTIC_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app_name: str = "cartlayers", master: str | None = None, **conf: str) -> SparkSession:
    """Create or reuse a session; `master` is only for local use, spark-submit sets it on a cluster."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**EXECUTION_SETTINGS, **SEMANTIC_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return pin_semantics(builder.getOrCreate())
