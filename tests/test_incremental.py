"""Incremental runs against full ones over the same landing files."""

from __future__ import annotations

import csv

import pytest
from pyspark.sql import functions as F

from cartlayers.__main__ import main
from cartlayers.plans import incremental as inc
from cartlayers.plans.layers import run_all
from cartlayers.plans.maintained import GROUPS
from cartlayers.registry import TABLES
from cartlayers.sources.arrivals import land
from cartlayers.sources.releases import ReleaseStore
from cartlayers.sources.tables import create_databases, read_tables
from tests import landing
from tests.landing import PREFIX, write_landing
from tests.test_layers import make_settings


def arrive(folder, dirty=False, name="2"):
    """The rows that only dirty landing files have, as further files."""
    files = {
        "orders_dataset": [(o, c, s, b, b, "", d, e) for o, c, s, b, d, e in landing.DIRTY_ORDERS],
        "order_items_dataset": landing.DIRTY_ITEMS,
        "order_reviews_dataset": landing.DIRTY_REVIEWS,
    }
    for file, rows in files.items():
        with open(folder / f"{PREFIX}{file}.csv", encoding="utf-8") as first:
            header = first.readline()
        with open(folder / f"{PREFIX}{file}_{name}.csv", "w", newline="", encoding="utf-8") as out:
            out.write(header)
            csv.writer(out, lineterminator="\n").writerows(rows)


def content(frames):
    return {n: sorted(map(repr, df.drop("_ingest_timestamp", "_source_file").collect())) for n, df in frames.items()}


def layer(spark, settings, name, tables):
    return content(read_tables(spark, settings, name, tables))


def versions(spark, settings):
    return {n: ReleaseStore.of(spark, settings, n).versions() for n in ("bronze", "silver", "gold")}


@pytest.fixture(scope="module")
def expected(spark, tmp_path_factory):
    found = {}
    for dirty in (False, True):
        folder = tmp_path_factory.mktemp("full")
        write_landing(folder, dirty=dirty)
        settings = make_settings(folder, f"full_{dirty}")
        run_all(spark, settings, gate_layers=())
        found[dirty] = {n: layer(spark, settings, n, t) for n, t in (("bronze", TABLES), ("silver", TABLES), ("gold", GROUPS))}
    return found


def assert_like_full(spark, settings, expected):
    for name, tables in (("bronze", TABLES), ("silver", TABLES), ("gold", GROUPS)):
        assert layer(spark, settings, name, tables) == expected[name]
    # the catalog follows
    for name, tables in (("silver", TABLES), ("gold", GROUPS)):
        assert content({t: spark.table(settings.table(name, t)) for t in tables}) == expected[name]


def test_new_files_are_merged_and_nothing_else_is_read(spark, tmp_path, expected):
    write_landing(tmp_path, dirty=False)
    settings = make_settings(tmp_path, "inc")
    first = inc.run_incremental(spark, settings, "one", ("silver", "gold"), buckets=8)
    assert first.rebuilt is True and all(len(p) == 1 for p in first.landed.values())
    assert_like_full(spark, settings, expected[False])
    before = versions(spark, settings)
    idle = inc.run_incremental(spark, settings, "idle", buckets=8)
    assert (set(map(len, idle.landed.values())), idle.touched, idle.rebuilt) == ({0}, {}, None)
    assert versions(spark, settings) == before
    arrive(tmp_path)
    second = inc.run_incremental(spark, settings, "two", (), buckets=8)
    assert {n for n, p in second.landed.items() if p} == set(second.touched) == {"orders", "order_items", "reviews"}
    assert all(len(p) < 8 for p in second.touched.values()) and second.rebuilt is False
    assert_like_full(spark, settings, expected[True])
    assert len(read_tables(spark, settings, "bronze", ["orders"])["orders"].select("_source_file").distinct().collect()) == 2
    # forgotten releases cost a rebuild, not a wrong result
    for name in ("bronze", "silver"):
        ReleaseStore.of(spark, settings, name).vacuum(keep=1, min_age=0)
    arrive(tmp_path, name="3")
    inc.run_incremental(spark, settings, "three", (), buckets=8)
    silver, gold = (layer(spark, settings, n, t) for n, t in (("silver", TABLES), ("gold", GROUPS)))
    assert (silver, gold) == (expected[True]["silver"], expected[True]["gold"])


def test_a_full_run_is_continued_by_loading_all_files_once(spark, tmp_path, expected):
    write_landing(tmp_path, dirty=False)
    settings = make_settings(tmp_path, "switch")
    run_all(spark, settings)
    arrive(tmp_path)
    inc.run_incremental(spark, settings, "a", (), buckets=4)
    assert_like_full(spark, settings, expected[True])


class Dies(RuntimeError):
    pass


def test_a_run_that_breaks_off_repeats_nothing(spark, tmp_path, monkeypatch, expected):
    write_landing(tmp_path, dirty=False)
    settings = make_settings(tmp_path, "broken")
    create_databases(spark, settings)

    def die(*_, **__):
        raise Dies

    # between the release of a batch and its checkpoint
    with pytest.raises(Exception, match="Dies"):
        land(spark, settings, TABLES["orders"], after_release=die)
    assert read_tables(spark, settings, "bronze", ["orders"])["orders"].count() == 7
    # before the release of a batch
    monkeypatch.setattr(ReleaseStore, "commit", die)
    with pytest.raises(Exception, match="Dies"):
        land(spark, settings, TABLES["customers"])
    monkeypatch.undo()
    # between the cleaned and the business tables
    monkeypatch.setattr(inc, "refresh_gold", die)
    with pytest.raises(Dies):
        inc.run_incremental(spark, settings, "x", (), buckets=4)
    monkeypatch.undo()
    # while the cleaned tables are merged
    arrive(tmp_path)
    plain = inc.merged_table
    monkeypatch.setattr(inc, "merged_table", lambda spec, *a: die() if spec.name == "reviews" else plain(spec, *a))
    before = layer(spark, settings, "silver", TABLES)
    with pytest.raises(Dies):
        inc.run_incremental(spark, settings, "y", (), buckets=4)
    monkeypatch.undo()
    assert layer(spark, settings, "silver", TABLES) == before == expected[False]["silver"]
    assert inc.run_incremental(spark, settings, "z", (), buckets=4).rebuilt is True
    assert_like_full(spark, settings, expected[True])


def test_a_failed_gate_keeps_the_former_business_tables(spark, tmp_path):
    write_landing(tmp_path, dirty=False)
    settings = make_settings(tmp_path, "gated")
    inc.run_incremental(spark, settings, "one", buckets=4)
    before = layer(spark, settings, "gold", GROUPS)
    arrive(tmp_path)
    with pytest.raises(Exception, match="quality check"):
        inc.run_incremental(spark, settings, "two", buckets=4)
    assert layer(spark, settings, "gold", GROUPS) == before
    assert spark.table(settings.log_table).where(F.col("run_id") == "two").count() == 23


def test_a_file_with_another_header_is_refused(spark, tmp_path):
    write_landing(tmp_path, dirty=False)
    settings = make_settings(tmp_path, "header")
    create_databases(spark, settings)
    land(spark, settings, TABLES["sellers"])
    (tmp_path / f"{PREFIX}sellers_dataset_2.csv").write_text("seller_id,seller_city,seller_zip_code_prefix,seller_state\nx,y,1,z\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        land(spark, settings, TABLES["sellers"])
    assert read_tables(spark, settings, "bronze", ["sellers"])["sellers"].count() == 2


def test_command_line(spark, tmp_path, capsys):
    write_landing(tmp_path / "landing", dirty=False)
    options = ["--raw-path", str(tmp_path / "landing"), "--file-prefix", PREFIX, "--storage-path", str(tmp_path / "files")]
    main(["incremental", *options, "--run-id", "cli"])
    shown = capsys.readouterr().out
    assert "run cli" in shown and "gold: rebuilt" in shown and "bronze.orders: 1 new batches" in shown
    main(["incremental", *options])
    assert "gold: up to date" in capsys.readouterr().out
    main(["repair", *options])
    main(["vacuum", *options, "--keep", "1"])
    assert "gold: 0 folders deleted" in capsys.readouterr().out
    assert spark.table("gold.receita_mensal").count() == 4


def test_a_lost_checkpoint_is_noticed(spark, tmp_path):
    write_landing(tmp_path, dirty=False)
    settings = make_settings(tmp_path, "lost_checkpoint")
    create_databases(spark, settings)
    land(spark, settings, TABLES["sellers"])
    store = ReleaseStore.of(spark, settings, "bronze")
    store.files.delete(f"{store.root}/arrivals/sellers")
    with pytest.raises(Exception, match="another checkpoint"):
        land(spark, settings, TABLES["sellers"])


def test_a_backlog_is_loaded_in_several_batches(spark, tmp_path):
    write_landing(tmp_path, dirty=False)
    arrive(tmp_path)
    arrive(tmp_path, name="3")
    settings = make_settings(tmp_path, "backlog")
    create_databases(spark, settings)
    assert len(land(spark, settings, TABLES["orders"], files=1)) == 3
    assert read_tables(spark, settings, "bronze", ["orders"])["orders"].count() == 7 + 2 * len(landing.DIRTY_ORDERS)
