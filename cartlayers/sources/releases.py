"""Releases: sets of tables that become visible together.

Every write of a table goes to a folder of its own, which is never written again. A release is a manifest
that names the folders of all tables of a layer; the one with the highest number counts. Making that
file is the only step that changes what readers see, so a run that dies at any point leaves either the
former set or the new one, a reader that has resolved a release keeps reading it, and a table can be
replaced by rows made from itself.

A table may have parts, folders that are replaced one by one (see `operators/merge.py`).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cartlayers.functions.text import quoted
from cartlayers.settings import Settings
from cartlayers.sources.files import Files

WHOLE = "whole"


class ConcurrentReleaseError(RuntimeError):
    """Another run has replaced the same tables in the meantime."""


@dataclass(frozen=True)
class Stored:
    """Where the rows of a table are: folders below the store's root, by the name of the part."""

    parts: Mapping[str, str]
    format: str
    schema: str
    notes: Mapping[str, object] = field(default_factory=dict)

    @property
    def struct(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class Release:
    version: int
    run_id: str
    tables: Mapping[str, Stored]


NOTHING = Release(0, "", {})


class ReleaseStore:
    """The releases of one layer."""

    def __init__(self, spark: SparkSession, root: str, table_format: str = "parquet"):
        self.spark, self.root, self.format = spark, root.rstrip("/"), table_format
        self.files = Files(spark)

    @staticmethod
    def of(spark: SparkSession, settings: Settings, layer: str) -> ReleaseStore:
        """The store of a layer, below `storage_path` or else the folder of the layer's database."""
        if settings.storage_path:
            base = f"{settings.storage_path.rstrip('/')}/{layer}"
        else:
            base = spark.catalog.getDatabase(settings.database(layer)).locationUri
        return ReleaseStore(spark, f"{base}/_releases", settings.table_format)

    # Reading.

    def _manifest(self, version: int) -> str:
        return f"{self.root}/manifests/{version:010d}.json"

    def versions(self) -> list[int]:
        names = self.files.names(f"{self.root}/manifests")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def release(self, version: int) -> Release:
        found = json.loads(self.files.read(self._manifest(version)))
        return Release(version, found["run_id"], {n: Stored(**t) for n, t in found["tables"].items()})

    def current(self) -> Release:
        versions = self.versions()
        return self.release(versions[-1]) if versions else NOTHING

    def folder(self, stored: Stored, part: str = WHOLE) -> str:
        return f"{self.root}/{stored.parts[part]}"

    def open(self, stored: Stored, parts: Iterable[str] | None = None) -> DataFrame:
        """The rows of a table, or of some of its parts only; folders of other parts are not even listed."""
        wanted = stored.parts if parts is None else [p for p in parts if p in stored.parts]
        paths = [self.folder(stored, p) for p in wanted]
        if not paths:
            return self.spark.createDataFrame([], stored.struct)
        return self.spark.read.format(stored.format).schema(stored.struct).load(paths)

    # Writing.

    def write(self, df: DataFrame, name: str, notes: Callable[[], Mapping[str, object]] | None = None) -> Stored:
        """Write a version of a table that no release names yet. `notes` is asked after the write."""
        place = f"tables/{name}/{uuid.uuid4().hex}"
        df.write.format(self.format).save(f"{self.root}/{place}")
        return Stored({WHOLE: place}, self.format, df.schema.json(), notes() if notes else {})

    def write_parts(self, df: DataFrame, name: str, part: str) -> Stored:
        """Write rows by the values of the column `part`, a folder each; the column is not stored with them."""
        place = f"tables/{name}/{uuid.uuid4().hex}"
        df.write.format(self.format).partitionBy(part).save(f"{self.root}/{place}")
        found = [n for n in self.files.names(f"{self.root}/{place}") if n.startswith(f"{part}=")]
        return Stored({n.split("=", 1)[1]: f"{place}/{n}" for n in found}, self.format, df.drop(part).schema.json())

    def discard(self, tables: Iterable[Stored]) -> None:
        """Delete versions that no release names."""
        for stored in tables:
            for place in stored.parts.values():
                self.files.delete(f"{self.root}/{place}")

    def commit(
        self, tables: Mapping[str, Stored], run_id: str = "", based_on: Release | None = None, removed: Sequence[str] = ()
    ) -> Release:
        """Make a release of `tables` and all other tables of the current one.

        With `based_on` the tables were made from that release: if any of them has changed since,
        ConcurrentReleaseError is raised and nothing changes. Without it the last writer counts.
        """
        while True:
            last = self.current()
            if based_on is not None:
                for name in (*tables, *removed):
                    if last.tables.get(name) != based_on.tables.get(name):
                        raise ConcurrentReleaseError(f"table '{name}' has changed since release {based_on.version}")
            kept = {n: t for n, t in last.tables.items() if n not in removed}
            release = Release(last.version + 1, run_id, {**kept, **tables})
            text = json.dumps({"run_id": run_id, "tables": {n: asdict(t) for n, t in release.tables.items()}})
            if self.files.create(self._manifest(release.version), text):
                return release

    def vacuum(self, keep: int = 10, min_age: float = 7 * 24 * 3600.0) -> list[str]:
        """Forget all but the last `keep` releases and delete the folders that only they named.

        Folders that changed less than `min_age` seconds ago stay, since a run may be about to release
        them. Readers of a forgotten release fail. Returns the deleted folders.
        """
        versions = self.versions()
        kept = [self.release(v) for v in versions[-keep:]] if keep > 0 else []
        named = {place for r in kept for t in r.tables.values() for place in t.parts.values()}
        for version in versions[: len(versions) - len(kept)]:
            self.files.delete(self._manifest(version))
        gone = []
        for name in self.files.names(f"{self.root}/tables"):
            for written in self.files.names(f"{self.root}/tables/{name}"):
                place = f"tables/{name}/{written}"
                parts = [p for p in self.files.names(f"{self.root}/{place}") if "=" in p]
                old = [f"{place}/{p}" for p in parts if f"{place}/{p}" not in named]
                if place not in named and len(old) == len(parts):
                    old = [place]
                gone += [p for p in old if self.files.age(f"{self.root}/{p}") >= min_age]
        for place in gone:
            self.files.delete(f"{self.root}/{place}")
        return gone


def expose(spark: SparkSession, settings: Settings, layer: str, store: ReleaseStore, release: Release) -> None:
    """Let the catalog's tables point at a release, for readers that know tables by name only.

    A table whose columns stay is moved in one step, so it is never missing. Several tables are moved one
    by one: readers that need one consistent set resolve the release. Repeating it mends what a broken
    run left behind. A table in parts is a view over its folders.
    """
    for name, stored in release.tables.items():
        if WHOLE in stored.parts:
            _point(spark, settings.table(layer, name), store.folder(stored), stored)
        else:
            _view(spark, settings.table(layer, name), store, stored)


def _facts(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says about a table; nothing if there is none."""
    if not spark.catalog.tableExists(table):
        return {}
    return {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}


def _point(spark: SparkSession, table: str, folder: str, stored: Stored) -> None:
    facts = _facts(spark, table)
    if facts.get("Type") == "EXTERNAL":
        if facts.get("Location", "").rstrip("/").endswith(folder.split(":", 1)[-1]):
            return
        if _shape(spark.table(table).schema) == _shape(stored.struct):
            place = folder.replace("'", "\\'")
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{place}'")
            spark.catalog.refreshTable(table)
            return
    if facts:
        spark.sql(f"DROP {'VIEW' if facts.get('Type') == 'VIEW' else 'TABLE'} {table}")
    spark.catalog.createTable(table, path=folder, source=stored.format, schema=stored.struct)


def _view(spark: SparkSession, table: str, store: ReleaseStore, stored: Stored) -> None:
    facts = _facts(spark, table)
    if facts and facts.get("Type") != "VIEW":
        spark.sql(f"DROP TABLE {table}")
    columns = [f"CAST({quoted(f.name)} AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in stored.struct]
    if stored.parts:
        # one scan over all folders, by a pattern that lists them
        source = f"{stored.format}.{quoted(store.root + '/{' + ','.join(stored.parts.values()) + '}')}"
    else:
        empty = ", ".join(f"NULL AS {quoted(f.name)}" for f in stored.struct)
        source = f"(SELECT {empty}) WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT {', '.join(columns)} FROM {source}")


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]
