"""Runs that handle only what is new: landing files, their keys, and the orders these change."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from cartlayers.operators.checks import enforce, log_verdicts
from cartlayers.operators.merge import BUCKETS, changed_parts, merge_first, rewrite_parts
from cartlayers.operators.typing import apply_types
from cartlayers.plans import gold as g
from cartlayers.plans import maintained
from cartlayers.plans.layers import new_run_id
from cartlayers.plans.silver import after_dedup, before_dedup, changes_kept_rows, clean, silver_checks
from cartlayers.registry import TABLES, TableSpec
from cartlayers.session import pinned
from cartlayers.settings import Settings
from cartlayers.sources.arrivals import FILES_PER_BATCH, land
from cartlayers.sources.releases import Release, ReleaseStore, Stored
from cartlayers.sources.tables import create_databases, publish, read_tables, transactional

TOTALS = "totais_"


@dataclass(frozen=True)
class IncrementalReport:
    """Parts loaded per raw table, buckets replaced per cleaned table, and whether totals were rebuilt."""

    run_id: str
    landed: Mapping[str, list[str]]
    touched: Mapping[str, tuple[str, ...]]
    rebuilt: bool | None


def _news(spec: TableSpec, store: ReleaseStore, bronze: Release, base: Release) -> tuple[list[str], bool]:
    """Raw parts that the cleaned table lacks, and whether it can be continued rather than built anew."""
    now = bronze.tables.get(spec.name)
    if now is None:
        return [], True
    known = base.tables.get(spec.name)
    since = known.notes.get("bronze_version") if known else None
    then = store.release(since).tables.get(spec.name) if since in store.versions() else None
    if then is None or any(now.parts.get(p) != f for p, f in then.parts.items()):
        return sorted(now.parts), False
    return changed_parts(then, now), True


def merged_table(
    spec: TableSpec, raw_store: ReleaseStore, raw: Stored, news: list[str], store: ReleaseStore, base: Release, part: str, buckets: int
) -> tuple[dict[str, Stored], tuple[str, ...]]:
    """New versions of a cleaned table and of what it is kept from, and the parts replaced.

    Deduplicated tables take the new rows into their buckets; rows are kept as they are compared
    (`<name>_kept`) and as they are cleaned, where that differs. Tables that keep all rows get a part.
    Centroids are means over all points of a prefix and are made anew.
    """
    if spec.points:
        return {spec.name: store.write(clean(spec, raw_store.open(raw)), spec.name)}, (spec.name,)
    rows = raw_store.open(raw, news)
    former = base.tables.get(spec.name)
    if not spec.dedup_key:
        fresh = store.write(apply_types(rows, spec.types), spec.name)
        parts = {**(former.parts if former else {}), part: next(iter(fresh.parts.values()))}
        return {spec.name: Stored(parts, fresh.format, fresh.schema)}, (part,)
    kept = f"{spec.name}_kept"
    done = merge_first(store, kept, before_dedup(spec, rows), spec.dedup_key, spec.dedup_order, buckets, base)
    if not changes_kept_rows(spec):
        return {kept: done.stored, spec.name: done.stored}, done.touched
    cleaned = after_dedup(spec, store.open(done.stored, done.touched))
    fresh = rewrite_parts(store, spec.name, cleaned, spec.dedup_key, done.stored.notes["buckets"])
    left = {p: f for p, f in (former.parts if former else {}).items() if p not in done.touched}
    return {kept: done.stored, spec.name: Stored({**left, **fresh.parts}, fresh.format, fresh.schema)}, done.touched


def merge_silver(
    spark: SparkSession, settings: Settings, run_id: str, gate: bool = False, buckets: int = BUCKETS
) -> dict[str, tuple[str, ...]]:
    """Bring the cleaned tables up to the current raw ones; the parts replaced per table.

    All tables are released together, after their keys and references were checked. Without new raw parts
    nothing is read or written. A table whose raw rows were replaced, or that was cleaned as a whole before,
    is built anew.
    """
    raw_store, store = (ReleaseStore.of(spark, settings, layer) for layer in ("bronze", "silver"))
    bronze, base = raw_store.current(), store.current()
    made: dict[str, Stored] = {}
    touched: dict[str, tuple[str, ...]] = {}
    try:
        for name, spec in TABLES.items():
            news, continued = _news(spec, raw_store, bronze, base)
            if not news:
                continue
            own = base if continued else Release(base.version, "", {})
            found, touched[name] = merged_table(
                spec, raw_store, bronze.tables[name], news, store, own, f"v{bronze.version:010d}", buckets
            )
            found[name] = replace(found[name], notes={"bronze_version": bronze.version})
            made |= found
        if not made:
            return {}
        tables = {n: store.open({**base.tables, **made}[n]) for n in TABLES if n in {**base.tables, **made}}
        if set(tables) == set(TABLES):
            log_verdicts(silver_checks(tables), settings, run_id, "silver")
            if gate:
                enforce(spark.table(settings.log_table), "silver", run_id)
    except BaseException:
        _discard_new(store, made, base)
        raise
    publish(spark, settings, "silver", made, run_id, base, exposed=TABLES)
    return touched


def _discard_new(store: ReleaseStore, made: Mapping[str, Stored], base: Release) -> None:
    """Delete the folders of tables that are not released; those that the base names stay."""
    named = {f for t in base.tables.values() for f in t.parts.values()}
    folders = {f for t in made.values() for f in t.parts.values()} - named
    store.discard([Stored({f: f for f in folders}, "", "")])


def refresh_gold(
    spark: SparkSession,
    settings: Settings,
    run_id: str,
    gate: bool = True,
    min_orders: int = g.MIN_ORDERS,
) -> bool | None:
    """Bring the business tables up to the current cleaned ones.

    True if their totals were built from all orders, False if from the affected ones only, None if they
    were up to date. Totals and business tables are released together with the release of the cleaned
    tables they stand for, so that the next run knows what has changed since.
    """
    silver_store, store = (ReleaseStore.of(spark, settings, layer) for layer in ("silver", "gold"))
    silver, base = silver_store.current(), store.current()
    after = {n: silver_store.open(silver.tables[n]) for n in TABLES}
    held = {n: base.tables.get(TOTALS + n) for n in maintained.GROUPS}
    since = {t.notes.get("silver_version") for t in held.values() if t} if all(held.values()) else set()
    then = since.pop() if len(since) == 1 else None
    if then == silver.version:
        return None
    made: dict[str, Stored] = {}
    scratch: list[Stored] = []
    try:
        if then in silver_store.versions():
            former = silver_store.release(then)
            before = {n: silver_store.open(former.tables[n]) for n in maintained.SOURCES}
            differing = {}
            for name in maintained.SOURCES:
                old, new = former.tables[name], silver.tables[name]
                parts = changed_parts(old, new)
                if parts:
                    differing[name] = (silver_store.open(old, parts), silver_store.open(new, parts))
            scratch.append(store.write(maintained.changed_orders(before, after, differing), "affected"))
            stored = {n: store.open(t) for n, t in held.items()}
            sums = maintained.refreshed(stored, before, after, store.open(scratch[0]))
        else:
            sums = maintained.totals(after)
        for name, df in sums.items():
            made[TOTALS + name] = replace(store.write(df, TOTALS + name), notes={"silver_version": silver.version})
        written = {n: store.open(made[TOTALS + n]) for n in sums}
        for name, df in maintained.shown(written, after["sellers"], min_orders).items():
            made[name] = store.write(df, name)
        own = {n: store.open(made[n]) for n in maintained.GROUPS}
        log_verdicts(g.gold_checks(own, after["order_items"], min_orders), settings, run_id, "gold")
        if gate:
            enforce(spark.table(settings.log_table), "gold", run_id)
    except BaseException:
        store.discard(made.values())
        raise
    finally:
        store.discard(scratch)
    publish(spark, settings, "gold", made, run_id, base, exposed=maintained.GROUPS)
    return then not in silver_store.versions()


def run_incremental(
    spark: SparkSession,
    settings: Settings,
    run_id: str | None = None,
    gate_layers: tuple[str, ...] = ("gold",),
    min_orders: int = g.MIN_ORDERS,
    files: int = FILES_PER_BATCH,
    buckets: int = BUCKETS,
) -> IncrementalReport:
    """Load new landing files, merge their rows and refresh the business tables.

    The result is that of a full run over all files that have arrived so far, as long as keys and rows
    alone decide which copy stays. Any step may break off; the next run goes on from the last release.
    """
    if transactional(settings):
        raise ValueError("incremental runs need releases, which a transactional format does without")
    run_id = run_id or new_run_id()
    with pinned(spark):
        create_databases(spark, settings)
        landed = {name: land(spark, settings, spec, run_id, files) for name, spec in TABLES.items()}
        touched = merge_silver(spark, settings, run_id, "silver" in gate_layers, buckets)
        ready = set(TABLES) <= set(ReleaseStore.of(spark, settings, "silver").current().tables)
        rebuilt = refresh_gold(spark, settings, run_id, "gold" in gate_layers, min_orders) if ready else None
    return IncrementalReport(run_id, landed, touched, rebuilt)


def business_tables(spark: SparkSession, settings: Settings) -> dict[str, DataFrame]:
    """The business tables of the current release, in display order."""
    return {n: g.present(n, df) for n, df in read_tables(spark, settings, "gold", maintained.GROUPS).items()}
