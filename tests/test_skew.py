"""Left joins with heavy keys."""

from __future__ import annotations

from statistics import median

import pytest
from pyspark.sql import functions as F

from cartlayers.operators import skew as m


@pytest.fixture(scope="module")
def sides(spark):
    """40 keys; of the right side one key has a third of the rows, another a tenth, five have none; missing keys on both sides."""
    left = spark.range(40).selectExpr("CASE WHEN id = 39 THEN NULL ELSE int(id) END AS k", "concat('l', id) AS name")
    left = left.unionByName(left.where("k IN (1, 2)"))
    right = spark.range(20_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 WHEN id % 10 = 1 THEN 2 WHEN id % 97 = 0 THEN NULL ELSE int(3 + id % 31) END AS k", "id AS value"
    )
    return left, right


def content(df):
    return sorted(map(repr, df.select("k", "name", "value").collect()))


def test_the_sketch_finds_the_heavy_keys(sides):
    assert m.heavy_keys(sides[1], "k", 0.05) == ["1", "2"]
    assert m.heavy_keys(sides[1].limit(0), "k") == []


def test_heavy_keys_are_observed_while_rows_are_written(sides, tmp_path):
    rows, keys = m.observed_heavy_keys(sides[1].withColumn("other", F.lit("x")), ["k", "other"], 0.05)
    rows.write.parquet(str(tmp_path / "rows"))
    assert keys() == {"k": ["1", "2"], "other": ["x"]}


@pytest.mark.parametrize("heavy", [None, [], ["1"], ["1", "2", "7"]])
def test_rows_are_those_of_a_plain_join(sides, heavy):
    left, right = sides
    assert content(m.left_join(left, right, "k", heavy)) == content(left.join(right, "k", "left"))


def test_empty_sides(sides):
    left, right = sides
    assert content(m.left_join(left, right.limit(0), "k")) == content(left.join(right.limit(0), "k", "left"))
    assert m.left_join(left.limit(0), right, "k").count() == 0


def test_no_task_has_much_more_than_others_and_each_side_is_read_once(spark, sides, tmp_path):
    left, right = sides
    right.write.parquet(str(tmp_path / "right"))
    left.write.parquet(str(tmp_path / "left"))
    left, right = spark.read.parquet(str(tmp_path / "left")), spark.read.parquet(str(tmp_path / "right"))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)

        def largest(df):
            rows = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            return max(rows) / median(rows + [0] * (8 - len(rows)))

        heavy = m.heavy_keys(right, "k")
        salted = m.left_join(left, right, "k", heavy)
        assert largest(salted) <= 2 < largest(left.join(right, "k", "left"))
        plan = salted._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 2 and plan.count("Join") == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
