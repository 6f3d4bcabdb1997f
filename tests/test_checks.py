"""One violating row flips the verdict of every check."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrame

from cartlayers.operators import checks as c
from cartlayers.operators.profile import null_profile
from cartlayers.operators.references import orphan_count, orphans, with_matches
from cartlayers.operators.rules import outside_range, outside_range_count


def verdict(df: DataFrame) -> tuple[str, str]:
    (row,) = df.collect()
    assert df.columns == list(c.VERDICT_COLUMNS)
    return row.status, row.detalhe


def frame(spark, schema: str, *rows):
    return spark.createDataFrame(list(rows), schema)


def test_row_count(spark):
    df = spark.range(3)
    assert verdict(c.row_count_match(df, spark.range(3), "bronze", "t")) == (
        "PASSOU",
        "origem=3, gravado=3",
    )
    assert verdict(c.row_count_match(df, spark.range(2), "bronze", "t"))[0] == "FALHOU"
    assert verdict(c.row_count_match(2, spark.range(2), "bronze", "t"))[0] == "PASSOU"
    assert verdict(c.row_count_match(3, spark.range(2), "bronze", "t"))[0] == "FALHOU"


@pytest.mark.parametrize(
    "keys, status, detail",
    [
        (["a", "b"], "PASSOU", "2 vs 2"),
        (["a", "a"], "FALHOU", "2 vs 1"),
        (["a", None], "PASSOU", "2 vs 2"),
        ([None, None], "FALHOU", "2 vs 1"),
        ([], "PASSOU", "0 vs 0"),
    ],
)
def test_unique_key(spark, keys, status, detail):
    df = frame(spark, "k string", *[(k,) for k in keys])
    assert verdict(c.unique_key(df, "silver", "t", "k")) == (status, detail)


@pytest.mark.parametrize(
    "refs, status, detail",
    [
        (["a", "a"], "PASSOU", "0 órfãos"),
        (["a", "x", "x"], "FALHOU", "2 órfãos"),
        (["a", None], "FALHOU", "1 órfãos"),
        ([], "PASSOU", "0 órfãos"),
    ],
)
def test_referential_integrity(spark, refs, status, detail):
    child = frame(spark, "fk string", *[(k,) for k in refs])
    parent = frame(spark, "pk string", ("a",), ("b",), (None,))
    check = c.referential_integrity(child, "fk", parent, "pk", "silver", "child", "parent")
    assert verdict(check) == (status, detail)
    (total,) = orphan_count(child, "fk", parent, "pk").first()
    assert total == orphans(child, "fk", parent, "pk").count()


def test_referential_integrity_with_equal_column_names(spark):
    child = frame(spark, "id string", ("a",), ("x",))
    parent = frame(spark, "id string", ("a",))
    assert verdict(c.referential_integrity(child, "id", parent, "id", "silver", "c", "p"))[1] == "1 órfãos"


@pytest.mark.parametrize(
    "gold, silver, status",
    [
        (["1.00", "2.00"], ["3.00"], "PASSOU"),
        (["3.01"], ["3.00"], "FALHOU"),
        ([], ["3.00"], "FALHOU"),
        ([], [], "FALHOU"),
    ],
)
def test_sum_reconciliation(spark, gold, silver, status):
    def total(values):
        return frame(spark, "v string", *[(v,) for v in values]).selectExpr(
            "cast(v as decimal(10,2)) v"
        )

    check = c.sum_reconciliation(total(gold), "v", total(silver), "v", "gold", "t")
    assert verdict(check)[0] == status


@pytest.mark.parametrize(
    "rule, good, bad",
    [
        (lambda: c.negative("v"), 0, -1),
        (lambda: c.outside("v", 0, 100), 100, 101),
        (lambda: c.outside("v", 1, 5), 1, 0),
        (lambda: c.below("v", 5), 5, 4),
    ],
)
def test_row_rules(spark, rule, good, bad):
    rules = [c.RowRule("r", rule(), "x")]
    passing = frame(spark, "v int", (good,), (None,))
    assert verdict(c.row_rules(passing, "gold", "t", rules)) == ("PASSOU", "0 x")
    failing = frame(spark, "v int", (good,), (bad,))
    assert verdict(c.row_rules(failing, "gold", "t", rules)) == ("FALHOU", "1 x")


def test_missing_value_rule(spark):
    rules = [c.RowRule("r", c.missing("v"), "nulos")]
    assert verdict(c.row_rules(frame(spark, "v string", ("",)), "gold", "t", rules))[0] == "PASSOU"
    assert verdict(c.row_rules(frame(spark, "v string", (None,)), "gold", "t", rules))[0] == "FALHOU"


def test_several_rules_share_one_scan(spark):
    rules = [c.RowRule(f"r{i}", c.below("id", i), "x") for i in range(3)]
    rows = c.row_rules(spark.range(5), "gold", "t", rules).collect()
    assert [(r.checagem, r.detalhe) for r in rows] == [("r0", "0 x"), ("r1", "1 x"), ("r2", "2 x")]


@pytest.mark.parametrize(
    "found, status, detail",
    [
        (["a", "b", "b"], "PASSOU", "[a, b] fora da lista: 0"),
        (["a"], "FALHOU", "[a] fora da lista: 0"),
        (["a", "b", "z"], "FALHOU", "[a, b] fora da lista: 1"),
        (["a", "b", None], "FALHOU", "[a, b] fora da lista: 1"),
        ([], "FALHOU", "[] fora da lista: 0"),
    ],
)
def test_category_set(spark, found, status, detail):
    df = frame(spark, "v string", *[(v,) for v in found])
    assert verdict(c.category_set(df, "v", ("a", "b"), "gold", "t")) == (status, detail)


def test_null_profile_counts_null_and_empty(spark):
    df = frame(
        spark,
        "a string, b int, c string, _source_file string",
        ("", 1, "x", None),
        (None, None, "y", None),
        ("z", 2, " ", None),
    )
    assert [tuple(r) for r in null_profile(df, "t").collect()] == [
        ("t", 1, "a", "string", 66.67),
        ("t", 2, "b", "int", 33.33),
        ("t", 3, "c", "string", 0.0),
    ]


def test_null_profile_of_an_empty_table(spark):
    assert [r.pct_nulos for r in null_profile(frame(spark, "a string"), "t").collect()] == [None]


def test_outside_range_ignores_missing_values(spark):
    df = frame(spark, "v int", (0,), (1,), (5,), (6,), (None,))
    assert [r.v for r in outside_range(df, "v", 1, 5).collect()] == [0, 6]
    assert outside_range_count(df, "v", 1, 5).first()[0] == 2


def test_with_matches_is_a_left_outer_join(spark):
    left = frame(spark, "k string, a int", ("x", 1), ("y", 2), (None, 3))
    right = frame(spark, "k string, b int", ("x", 10), ("x", 11), ("z", 12), (None, 13))
    found = sorted(map(tuple, with_matches(left, right, "k").collect()), key=str)
    assert found == sorted(map(tuple, left.join(right, "k", "left").collect()), key=str)
    assert len(found) == 4
