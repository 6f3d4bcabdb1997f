"""Catalog tables of the three layers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlayers.functions.text import literal, quoted
from cartlayers.settings import Settings
from cartlayers.sources.releases import Release, ReleaseStore, Stored, expose


def create_databases(spark: SparkSession, settings: Settings) -> None:
    for layer in ("bronze", "silver", "gold"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {settings.database(layer)}")


def transactional(settings: Settings) -> bool:
    """Whether the write format replaces a table in one step by itself."""
    return settings.table_format == "delta"


def read_table(spark: SparkSession, settings: Settings, layer: str, name: str) -> DataFrame:
    """A table as the current release has it, or as the catalog has it if no release does."""
    return read_tables(spark, settings, layer, [name])[name]


def read_tables(spark: SparkSession, settings: Settings, layer: str, names: Iterable[str]) -> dict[str, DataFrame]:
    """Tables of one and the same release."""
    release = store = None
    if not transactional(settings):
        store = ReleaseStore.of(spark, settings, layer)
        release = store.current()
    return {
        n: store.open(release.tables[n]) if release and n in release.tables else spark.table(settings.table(layer, n))
        for n in names
    }


def table_notes(spark: SparkSession, settings: Settings, layer: str, name: str) -> Mapping[str, object]:
    """What was noted when the current version of a table was written."""
    if transactional(settings):
        return {}
    found = ReleaseStore.of(spark, settings, layer).current().tables.get(name)
    return found.notes if found else {}


def overwrite_table(
    df: DataFrame, settings: Settings, layer: str, name: str, replace_schema: bool = False
) -> None:
    """Replace a table; its readers see the former rows until the new ones are complete.

    Delta replaces the rows itself and has to be told to replace the schema too.
    """
    spark = df.sparkSession
    if transactional(settings):
        writer = df.write.format(settings.table_format).mode("overwrite")
        if replace_schema:
            writer = writer.option("overwriteSchema", "true")
        writer.saveAsTable(settings.table(layer, name))
        return
    store = ReleaseStore.of(spark, settings, layer)
    publish(spark, settings, layer, {name: store.write(df, name)})


def publish(
    spark: SparkSession,
    settings: Settings,
    layer: str,
    tables: Mapping[str, Stored],
    run_id: str = "",
    based_on: Release | None = None,
    exposed: Iterable[str] | None = None,
) -> Release:
    """Release written tables together, then let the catalog follow, for all or the `exposed` ones."""
    store = ReleaseStore.of(spark, settings, layer)
    release = store.commit(tables, run_id, based_on)
    names = [n for n in tables if exposed is None or n in exposed]
    expose(spark, settings, layer, store, replace(release, tables={n: release.tables[n] for n in names}))
    return release


class Pending:
    """Tables of a layer that a run writes, reads back and checks before anyone else sees them.

    Use it in a `with` statement: what was not published when it ends is deleted.
    """

    def __init__(self, spark: SparkSession, settings: Settings, layer: str, run_id: str):
        self.spark, self.settings, self.layer, self.run_id = spark, settings, layer, run_id
        self.written: dict[str, Stored] = {}
        self.drafts: dict[str, DataFrame] = {}
        self.store = None if transactional(settings) else ReleaseStore.of(spark, settings, layer)

    def write(
        self, name: str, df: DataFrame, notes: Callable[[], Mapping[str, object]] | None = None
    ) -> DataFrame:
        """Store a table and return its stored rows; a release keeps the `notes` taken after the write."""
        if self.store is None:
            table = self.settings.table(self.layer, run_name(name, self.run_id))
            df.write.format(self.settings.table_format).mode("overwrite").saveAsTable(table)
            self.drafts[name] = self.spark.table(table)
        else:
            self.written[name] = self.store.write(df, name, notes)
            self.drafts[name] = self.store.open(self.written[name])
        return self.drafts[name]

    def publish(self) -> None:
        """Let readers see all tables; at once, if the layer has releases."""
        if self.store is None:
            for name, draft in self.drafts.items():
                overwrite_table(draft, self.settings, self.layer, name, replace_schema=True)
            return
        written, self.written = self.written, {}
        publish(self.spark, self.settings, self.layer, written, self.run_id)

    def __enter__(self) -> Pending:
        return self

    def __exit__(self, *error: object) -> None:
        if self.store is None:
            drop_tables(self.spark, self.settings, self.layer, self.drafts, self.run_id)
        else:
            self.store.discard(self.written.values())


def repair_catalog(spark: SparkSession, settings: Settings, layer: str) -> None:
    """Point the catalog's tables at the current release, after a run that broke off while doing so."""
    store = ReleaseStore.of(spark, settings, layer)
    expose(spark, settings, layer, store, store.current())


def append_table(df: DataFrame, settings: Settings, layer: str, name: str) -> None:
    df.write.format(settings.table_format).mode("append").saveAsTable(settings.table(layer, name))


def replace_batch(df: DataFrame, settings: Settings, layer: str, name: str, **batch: str) -> None:
    """Put rows into a table in the place of those of the same batch.

    The table is partitioned by the columns that name the batch, which come last; `df` need not have them.
    Writing the same batch again, after a failure or on purpose, leaves its rows once.
    """
    spark, table = df.sparkSession, settings.table(layer, name)
    rows = df.drop(*batch).withColumns({c: F.lit(v) for c, v in batch.items()})
    if transactional(settings):
        same = " AND ".join(f"{c} = {literal(v)}" for c, v in batch.items())
        writer = rows.write.format(settings.table_format).mode("overwrite").partitionBy(*batch)
        writer.option("replaceWhere", same).saveAsTable(table)
        return
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in rows.schema)
    names = ", ".join(quoted(c) for c in batch)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {settings.table_format} PARTITIONED BY ({names})")
    part = ", ".join(f"{quoted(c)} = {literal(v)}" for c, v in batch.items())
    view = f"batch_{uuid.uuid4().hex}"
    rows.drop(*batch).createTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({part}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def run_name(name: str, run_id: str) -> str:
    """Name of a table that belongs to one run until it is published."""
    return f"{name}__{''.join(c if c.isalnum() else '_' for c in run_id)}"


def stage(df: DataFrame, settings: Settings, name: str, run_id: str) -> DataFrame:
    """Write a shared intermediate result of a run once and scan it back, which also cuts its lineage.

    It is a table beside the gold tables, on the same shared storage; `drop_tables` removes it.
    """
    table = settings.table("gold", run_name(name, run_id))
    df.write.format(settings.table_format).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def drop_tables(spark: SparkSession, settings: Settings, layer: str, names: Iterable[str], run_id: str) -> None:
    """Drop what is left of a run's tables."""
    for name in names:
        spark.sql(f"DROP TABLE IF EXISTS {settings.table(layer, run_name(name, run_id))}")
