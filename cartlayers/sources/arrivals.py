"""Landing files as a stream: every file is loaded once, whenever it arrives.

The files of a table are a file stream whose checkpoint knows what was read. A batch of new files becomes
a part of the raw table, named after the batch, in one release. A run that breaks off after the release
and before the checkpoint is told the same batch again, finds its part and leaves it; one that breaks off
before leaves nothing. So a file is in the raw table once, and a run without new files reads none.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlayers.operators.merge import append_part
from cartlayers.registry import TableSpec
from cartlayers.settings import Settings
from cartlayers.sources.landing import INGEST_TIME, SOURCE_FILE, read_landing
from cartlayers.sources.releases import NOTHING, WHOLE, ReleaseStore

#: Files of one batch; a larger backlog is loaded in several.
FILES_PER_BATCH = 1000


def landing_pattern(settings: Settings, spec: TableSpec) -> str:
    """All files of a table: its landing name with anything before the ending, `orders_dataset*.csv`."""
    stem, dot, ending = settings.landing_path(spec.file).rpartition(".")
    return f"{stem}*{dot}{ending}"


def arrivals(spark: SparkSession, path: str, options: dict[str, str], files: int = FILES_PER_BATCH) -> DataFrame:
    """A stream of all-text rows with the audit columns.

    Names come from the header of the first file. A file with another header ends the run, rather than
    filling the wrong columns.
    """
    names = read_landing(spark, path, options).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    stream = spark.readStream.schema(schema).options(header=True, enforceSchema=False, maxFilesPerTrigger=files)
    rows = stream.options(**options).csv(path)
    return rows.select(*names, F.current_timestamp().alias(INGEST_TIME), F.col("_metadata.file_name").alias(SOURCE_FILE))


def land(
    spark: SparkSession,
    settings: Settings,
    spec: TableSpec,
    run_id: str = "",
    files: int = FILES_PER_BATCH,
    after_release: Callable[[int], None] = lambda batch: None,
) -> list[str]:
    """Load the files of a table that have arrived since the last time; the names of the parts made.

    A raw table that was loaded as a whole before is replaced, since the stream starts with all files.
    `after_release` is called between the release of a batch and its checkpoint.
    """
    store = ReleaseStore.of(spark, settings, "bronze")
    pattern = landing_pattern(settings, spec)
    folder, _, name = pattern.rpartition("/")
    first, _, last = name.partition("*")
    if not any(n.startswith(first) and n.endswith(last) for n in store.files.names(folder)):
        return []
    checkpoint = f"{store.root}/arrivals/{spec.name}"
    made: list[str] = []

    def add(batch: DataFrame, number: int) -> None:
        source = json.loads(store.files.read(f"{checkpoint}/metadata"))["id"]
        base = store.current()
        former = base.tables.get(spec.name)
        if former and former.notes.get("source", source) != source:
            raise RuntimeError(f"raw table '{spec.name}' belongs to another checkpoint; its files would be loaded twice")
        whole = former is not None and WHOLE in former.parts
        added = append_part(store, spec.name, batch, f"b{number:010d}", NOTHING if whole else base)
        if added.touched:
            stored = replace(added.stored, notes={"source": source})
            store.commit({spec.name: stored}, run_id, based_on=base)
            made.extend(added.touched)
        after_release(number)

    stream = arrivals(spark, pattern, dict(spec.reader), files)
    writer = stream.writeStream.foreachBatch(add).trigger(availableNow=True)
    query = writer.option("checkpointLocation", checkpoint).start()
    query.awaitTermination()
    return made
