"""Releases: what readers see when runs overlap or break off anywhere."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import functions as F

from cartlayers.plans.layers import run_all, run_gold, run_silver
from cartlayers.registry import TABLES
from cartlayers.settings import Settings
from cartlayers.sources import releases, tables
from cartlayers.sources.files import Files
from cartlayers.sources.releases import ConcurrentReleaseError, ReleaseStore
from cartlayers.sources.tables import overwrite_table, read_table, read_tables, repair_catalog
from tests.landing import write_landing
from tests.test_layers import make_settings

GOLD = ["receita_mensal", "receita_por_estado", "performance_entrega_mensal", "satisfacao_entrega", "ranking_vendedores"]


class Dies(RuntimeError):
    pass


def numbers(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "n int")


def seen(store, name):
    return sorted(r.n for r in store.open(store.current().tables[name]).collect())


@pytest.fixture
def store(spark, tmp_path):
    return ReleaseStore(spark, str(tmp_path / "store"))


def test_a_release_keeps_the_tables_it_does_not_replace(spark, store):
    assert store.current() == releases.NOTHING
    store.commit({n: store.write(numbers(spark, 1), n) for n in ("a", "b")}, "one")
    store.commit({"a": store.write(numbers(spark, 2, 3), "a")}, "two")
    assert (seen(store, "a"), seen(store, "b")) == ([2, 3], [1])
    assert [store.release(v).run_id for v in store.versions()] == ["one", "two"]
    assert set(store.commit({}, "three", removed=["b"]).tables) == {"a"}


def test_readers_keep_the_release_they_resolved(spark, store):
    old = store.commit({"a": store.write(numbers(spark, 1), "a")})
    rows = store.open(old.tables["a"])
    store.commit({"a": store.write(numbers(spark, 2), "a")})
    assert [r.n for r in rows.collect()] == [1]


def test_a_table_is_replaced_by_rows_made_from_itself(spark, store):
    store.commit({"a": store.write(numbers(spark, 1, 2), "a")})
    own = store.open(store.current().tables["a"])
    store.commit({"a": store.write(own.select((F.col("n") * 10).alias("n")), "a")})
    assert seen(store, "a") == [10, 20]


def test_only_one_of_several_writers_makes_a_version(spark, tmp_path):
    files, made = Files(spark), []
    path = f"{tmp_path}/manifests/1.json"
    threads = [threading.Thread(target=lambda i=i: made.append((files.create(path, f"by {i}"), i))) for i in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    winners = [i for ok, i in made if ok]
    assert len(made) == 8 and len(winners) == 1
    assert files.read(path) == f"by {winners[0]}" and files.names(f"{tmp_path}/manifests") == ["1.json"]


def test_concurrent_changes_of_one_table_conflict_and_others_do_not(spark, store):
    base = store.commit({n: store.write(numbers(spark, 0), n) for n in ("a", "b")})
    store.commit({"a": store.write(numbers(spark, 1), "a")}, based_on=base)
    store.commit({"b": store.write(numbers(spark, 2), "b")}, based_on=base)
    with pytest.raises(ConcurrentReleaseError, match="'a'"):
        store.commit({"a": store.write(numbers(spark, 3), "a")}, based_on=base)
    assert (seen(store, "a"), seen(store, "b")) == ([1], [2])


def test_vacuum_deletes_what_only_old_releases_name(spark, store):
    for v in range(4):
        store.commit({"a": store.write(numbers(spark, v), "a")})
    abandoned = store.write(numbers(spark, 9), "a")
    assert store.vacuum(keep=2) == []
    parts = store.write_parts(numbers(spark, 1, 2).withColumn("p", F.col("n")), "b", "p")
    store.commit({"b": parts})
    kept = {p: parts.parts[p] for p in ("2",)}
    store.commit({"b": releases.Stored(kept, parts.format, parts.schema)})
    gone = store.vacuum(keep=1, min_age=0)
    assert len(gone) == 5 and abandoned.parts["whole"] in gone and parts.parts["1"] in gone
    assert (seen(store, "a"), seen(store, "b")) == ([3], [2])
    assert len(store.versions()) == 1


def snapshot(spark, settings):
    return {n: sorted(map(repr, df.collect())) for n, df in read_tables(spark, settings, "gold", GOLD).items()}


@pytest.fixture(scope="module")
def ready(spark, tmp_path_factory):
    """A released clean run, and silver rows that give other business tables."""
    folder = tmp_path_factory.mktemp("crash")
    write_landing(folder, dirty=False)
    settings = make_settings(folder, "crash")
    run_all(spark, settings)
    items = read_table(spark, settings, "silver", "order_items")
    return settings, items, items.where("order_id <> 'o1'")


@pytest.mark.parametrize("write", range(5))
def test_a_run_that_dies_between_writes_changes_nothing(spark, ready, monkeypatch, write):
    settings, _, fewer = ready
    overwrite_table(fewer, settings, "silver", "order_items")
    before, plain, count = snapshot(spark, settings), ReleaseStore.write, []

    def failing(self, df, name, notes=None):
        count.append(name)
        if len(count) > write:
            raise Dies
        return plain(self, df, name, notes)

    monkeypatch.setattr(ReleaseStore, "write", failing)
    with pytest.raises(Dies):
        run_gold(spark, settings, "dies", gate=False)
    assert snapshot(spark, settings) == before
    assert not [t.name for t in spark.catalog.listTables(settings.gold) if "__" in t.name]


def test_a_run_that_dies_while_it_releases_changes_nothing(spark, ready, monkeypatch):
    settings, _, fewer = ready
    overwrite_table(fewer, settings, "silver", "order_items")
    before = snapshot(spark, settings)

    def failing(self, path, text):
        raise Dies

    monkeypatch.setattr(Files, "create", failing)
    with pytest.raises(Dies):
        run_gold(spark, settings, "dies", gate=False)
    monkeypatch.undo()
    assert snapshot(spark, settings) == before


@pytest.mark.parametrize("moved", range(5))
def test_a_run_that_dies_behind_its_release_shows_all_new_tables(spark, ready, monkeypatch, moved):
    settings, items, fewer = ready
    overwrite_table(items, settings, "silver", "order_items")
    run_gold(spark, settings, "full")
    full = snapshot(spark, settings)
    overwrite_table(fewer, settings, "silver", "order_items")
    plain, count = releases._point, []

    def failing(*args):
        if len(count) == moved:
            raise Dies
        count.append(args)
        plain(*args)

    monkeypatch.setattr(releases, "_point", failing)
    with pytest.raises(Dies):
        run_gold(spark, settings, "dies", gate=False)
    monkeypatch.undo()
    after = snapshot(spark, settings)
    changed = [n for n in GOLD if after[n] != full[n]]
    assert {"receita_mensal", "receita_por_estado", "ranking_vendedores"} <= set(changed)
    # the catalog has a table of one of the two sets for every name, and follows when it is repaired
    for name in GOLD:
        assert sorted(map(repr, spark.table(settings.table("gold", name)).collect())) in (full[name], after[name])
    repair_catalog(spark, settings, "gold")
    for name in GOLD:
        assert sorted(map(repr, spark.table(settings.table("gold", name)).collect())) == after[name]


def test_a_gated_silver_run_that_fails_keeps_the_former_tables(spark, tmp_path):
    write_landing(tmp_path, dirty=False)
    settings = make_settings(tmp_path, "kept")
    run_all(spark, settings)
    before = {n: df.count() for n, df in read_tables(spark, settings, "silver", TABLES).items()}
    write_landing(tmp_path, dirty=True)
    with pytest.raises(Exception, match="quality check"):
        run_all(spark, settings, gate_layers=("silver",))
    assert {n: df.count() for n, df in read_tables(spark, settings, "silver", TABLES).items()} == before


def test_a_replaced_schema_reaches_the_catalog(spark, tmp_path):
    settings = make_settings(tmp_path, "schema")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {settings.gold}")
    for df in (numbers(spark, 1), spark.range(2).toDF("m"), spark.range(3).toDF("m")):
        overwrite_table(df, settings, "gold", "t", replace_schema=True)
        assert spark.table(settings.table("gold", "t")).columns == df.columns
        assert spark.table(settings.table("gold", "t")).count() == df.count()


def test_a_managed_table_of_before_is_replaced(spark, tmp_path):
    settings = make_settings(tmp_path, "managed")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {settings.gold}")
    numbers(spark, 7).write.saveAsTable(settings.table("gold", "t"))
    assert [r.n for r in read_table(spark, settings, "gold", "t").collect()] == [7]
    overwrite_table(read_table(spark, settings, "gold", "t").union(numbers(spark, 8)), settings, "gold", "t")
    assert sorted(r.n for r in spark.table(settings.table("gold", "t")).collect()) == [7, 8]


def test_storage_path_holds_all_layers(spark, tmp_path):
    write_landing(tmp_path / "landing", dirty=False)
    plain = make_settings(tmp_path / "landing", "placed")
    settings = Settings(**{**plain.__dict__, "storage_path": str(tmp_path / "files")})
    run_all(spark, settings)
    run_silver(spark, settings)
    assert {p.name for p in (tmp_path / "files").iterdir()} == {"bronze", "silver", "gold"}
    assert len(ReleaseStore.of(spark, settings, "silver").versions()) == 2
    assert tables.read_table(spark, settings, "gold", "receita_mensal").count() == 4
