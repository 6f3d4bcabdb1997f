"""Folders for results that live as long as the session."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import SparkSession

from cartlayers.sources.files import Files

_made: list[str] = []


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that all executors see: below spark.checkpoint.dir, or the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    _made.append(f"{base.rstrip('/')}/cartlayers-{uuid.uuid4().hex}")
    return _made[-1]


def remove_scratch(spark: SparkSession) -> None:
    """Delete all scratch folders of this process; frames that read them fail from then on."""
    files = Files(spark)
    while _made:
        files.delete(_made.pop())


@atexit.register
def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and _made:
        try:
            remove_scratch(spark)
        except Exception:  # the JVM may have gone first
            _made.clear()
