from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from cartlayers.llm import nearest as m
from tests.llm.fixtures import FOLDER, given

SCHEMA = "vec_id long, embedding array<float>, score double, key string"


def brute_force(rows: list, is_query, k: int) -> dict:
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    ids = np.array([i for i, _ in rows])
    found = {}
    for n, i in enumerate(ids):
        if is_query(i):
            score = x @ x[n]
            order = [int(ids[j]) for j in np.lexsort((ids, -score)) if ids[j] != i]
            found[int(i)] = order[:k]
    return found


def recall(df, expected: dict) -> float:
    got: dict = {}
    for r in df.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(got) == {q for q, near in expected.items() if near}
    hits = total = 0
    for q, near in expected.items():
        found = got.get(q, [])
        assert [r for r, _, _ in found] == list(range(1, len(near) + 1))
        assert all(a[2] >= b[2] for a, b in zip(found, found[1:], strict=False))
        hits += len({v for _, v, _ in found} & set(near))
        total += len(near)
    return hits / total


def vectors(n: int, seed: int, scale: bool = False) -> list:
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 16)) * (rng.uniform(0.1, 5, size=(n, 1)) if scale else 1)
    return [(i, [float(v) for v in row]) for i, row in enumerate(x)]


def test_recall_with_several_cells_and_norms(spark, monkeypatch):
    monkeypatch.setattr(m, "CELL_ROWS", 300)
    monkeypatch.setattr(m, "QUERIES_TOGETHER", 40)
    rows = vectors(1500, 1, scale=True)
    docs = spark.createDataFrame([(*r, 0.5, "x") for r in rows], SCHEMA)
    found = m.nearest(docs, F.col("vec_id") % 20 == 0, 10)
    assert recall(found, brute_force(rows, lambda i: i % 20 == 0, 10)) >= 0.95


def test_recall_on_the_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in given(spark, "embeddings").collect()]
    found = m.op2_nearest(spark, FOLDER)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    assert recall(found, brute_force(rows, lambda i: i % 20 == 0, 20)) >= 0.9


def test_equal_vectors_tie_by_id(spark):
    rows = [(i, [1.0, 2.0]) for i in range(60)] + [(60, [5.0, 5.0]), (80, [0.0, 1.0])]
    docs = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    found = m.nearest(docs, F.col("vec_id") % 20 == 0, 5)
    assert recall(found, brute_force(rows, lambda i: i % 20 == 0, 5)) == 1.0


def test_unusable_vectors_take_no_part(spark):
    good = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [0.0, 1.0])]
    bad = [(2, None), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (40, []), (7, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    docs = spark.createDataFrame([(*r, None, None) for r in [*good, *bad, good[1]]], SCHEMA)
    found = m.nearest(docs, F.col("vec_id") % 20 == 0, 20)
    assert recall(found, brute_force(good, lambda i: i % 20 == 0, 20)) == 1.0
    assert m.nearest(docs.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert m.nearest(docs.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0


def test_chi_square():
    # Known values for eight degrees of freedom.
    assert np.allclose(m.chi_square_below(np.array([0.0, 7.344, 15.507, 20.090])), [0, 0.5, 0.95, 0.99], atol=1e-4)
