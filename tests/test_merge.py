"""Merging batches into deduplicated tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cartlayers.operators import merge as m
from cartlayers.operators.dedup import keep_first
from cartlayers.sources.releases import ConcurrentReleaseError, ReleaseStore

SCHEMA = "a string, b int, x double, y string"
KEY = ["a", "b"]


def rows(seed: int, n: int = 120) -> list[tuple]:
    """Few keys, so that most have copies; missing values in every column and one hot key."""
    rng = random.Random(seed)

    def row():
        key = ("hot", 1) if rng.random() < 0.3 else (rng.choice(["p", "q", "r", None]), rng.choice([*range(8), None]))
        return (*key, rng.choice([1.0, 2.5, float("nan"), None]), rng.choice(["u", "v", "", None]))

    return [row() for _ in range(n)]


def content(df) -> list[str]:
    return sorted(map(repr, df.select("a", "b", "x", "y").collect()))


@pytest.fixture
def store(spark, tmp_path):
    return ReleaseStore(spark, str(tmp_path / "store"))


def merge(store, batch, name="t", **options):
    base = store.current()
    done = m.merge_first(store, name, batch, KEY, base=base, **options)
    store.commit({name: done.stored}, based_on=base)
    return done


@pytest.mark.parametrize("order", [(), ("y", "x")])
def test_batches_give_what_one_run_gives(spark, store, order):
    batches = [spark.createDataFrame(rows(seed), SCHEMA) for seed in range(5)]
    whole = batches[0]
    for n, batch in enumerate(batches):
        merge(store, batch, order=order, buckets=7)
        whole = whole.unionByName(batch) if n else batch
        stored = store.current().tables["t"]
        assert content(store.open(stored)) == content(keep_first(whole, KEY, order))
    for again in (batches[2], batches[0].select("y", "x", "b", "a")):
        merge(store, again, order=order)
        assert content(store.open(store.current().tables["t"])) == content(keep_first(whole, KEY, order))


def test_only_touched_buckets_are_read_and_replaced(spark, store):
    merge(store, spark.range(1000).selectExpr("string(id) AS a", "0 AS b", "1D AS x", "'y' AS y"), buckets=32)
    former = store.current().tables["t"]
    few = spark.createDataFrame([("5", 0, 0.5, "y"), ("new", 1, 1.0, None)], SCHEMA)
    done = merge(store, few)
    assert 1 <= len(done.touched) <= 2
    after = store.current().tables["t"]
    assert m.changed_parts(former, after) == sorted(done.touched)
    fresh = store.write_parts(few.withColumn(m.BUCKET, m.bucket_of(KEY, 32)), "probe", m.BUCKET)
    read = m.merging(store, former, fresh, KEY, (), 32).inputFiles()
    buckets = {part for path in read for part in path.split("/") if part.startswith(m.BUCKET)}
    assert buckets == {f"{m.BUCKET}={p}" for p in done.touched}
    found = {r.a: r.x for r in store.open(after).collect()}
    assert len(found) == 1001 and found["5"] == 0.5 and found["new"] == 1.0
    # the batch itself left no folder behind
    assert not store.files.names(f"{store.root}/tables/t_batch") or len(store.files.names(f"{store.root}/tables/t_batch")) <= 2


def test_a_merge_shuffles_once(spark, store):
    merge(store, spark.createDataFrame(rows(1), SCHEMA), buckets=4)
    former = store.current().tables["t"]
    fresh = store.write_parts(spark.createDataFrame(rows(2), SCHEMA).withColumn(m.BUCKET, m.bucket_of(KEY, 4)), "probe", m.BUCKET)
    plan = m.merging(store, former, fresh, KEY, (), 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_an_empty_batch_changes_nothing(spark, store):
    merge(store, spark.createDataFrame(rows(1), SCHEMA), buckets=4)
    before = store.current().tables["t"]
    assert merge(store, spark.createDataFrame([], SCHEMA)).touched == ()
    assert store.current().tables["t"].parts == before.parts


def test_another_rule_is_refused(spark, store):
    merge(store, spark.createDataFrame(rows(1), SCHEMA), buckets=4)
    with pytest.raises(ValueError, match="kept by"):
        m.merge_first(store, "t", spark.createDataFrame(rows(2), SCHEMA), ["a"])


def test_a_merge_in_between_is_noticed(spark, store):
    merge(store, spark.createDataFrame(rows(1), SCHEMA), buckets=4)
    base = store.current()
    first, second = (m.merge_first(store, "t", spark.createDataFrame(rows(s), SCHEMA), KEY, base=base) for s in (2, 3))
    store.commit({"t": first.stored}, based_on=base)
    with pytest.raises(ConcurrentReleaseError):
        store.commit({"t": second.stored}, based_on=base)


def test_a_part_is_appended_once(spark, store):
    for _ in range(2):
        for n in range(3):
            base = store.current()
            done = m.append_part(store, "t", spark.range(n + 1).selectExpr(f"{n} AS batch", "id"), f"b{n}", base)
            store.commit({"t": done.stored}, based_on=base)
    assert store.open(store.current().tables["t"]).count() == 6


def test_changed_keys_counts_copies(spark):
    before = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c"), (None, "n"), (5, "e")], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, None), (3, "d"), (None, "n"), (4, "x"), (None, "m")], "k int, v string")
    assert {r.k for r in m.changed_keys(before, after, ["k"]).collect()} == {1, 3, 4, 5, None}
    assert m.changed_keys(before, before.orderBy(F.desc("k")), ["k"]).collect() == []
