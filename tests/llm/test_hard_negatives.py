from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cartlayers.llm import hard_negatives as m
from tests.compare import connect, mismatch
from tests.llm.fixtures import FOLDER, given

SCHEMA = "vec_id long, embedding array<float>, label int, score double, anchor long, block int"
INF, NAN = float("inf"), float("nan")


def brute_force(rows) -> list[tuple]:
    rows = {
        i: (label, [math.floor(256 * np.float64(np.float32(x))) for x in v])
        for i, v, label in sorted(rows, key=lambda r: -1 if r[0] is None else r[0])
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    found = []
    for a, (label, v) in rows.items():
        if a % 100:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w, strict=True)), i, k) for i, (k, w) in rows.items() if i != a and len(w) == len(v)]
        scored.sort()
        for p, i, _ in [s for s in scored if s[2] == label][: m.POSITIVES]:
            inside = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p]
            found += [(a, i, n + 1, j, -p, -s) for n, (s, j, _) in enumerate(inside[: m.NEGATIVES])]
    return sorted(found)


def mined(spark, rows):
    df = spark.createDataFrame([(*r, 0.5, 7, 1) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in m.mine(df, F.col("vec_id") % 100 == 0, F.col("label")).collect())


def vectors(n, dim, seed, spread=1.0, clusters=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    x = centres[rng.integers(clusters, size=n)] + spread * rng.normal(size=(n, dim))
    return [(i, [float(c) for c in row], int(rng.integers(4))) for i, row in enumerate(x)]


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_many_groups_and_blocks(spark, monkeypatch, spread):
    monkeypatch.setattr(m, "BLOCK_ROWS", 700)
    monkeypatch.setattr(m, "GROUP_ANCHORS", 9)
    rows = vectors(2500, 8, 5, spread)
    assert mined(spark, rows) == brute_force(rows)


def test_query_agrees_with_sql(spark):
    df = m.op13_hard_negatives(spark, FOLDER)
    assert df.dtypes == [(c, "int" if c == "rank" else "bigint") for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")]
    assert df.count() and mismatch(df, connect(FOLDER), m.HARD_NEGATIVES_SQL) is None


def test_ties_copies_and_unusable_rows(spark):
    copies = [(i, [1.0, 0.5], i % 3) for i in range(300)] + [(300 + i, [0.5, 0.25], 1) for i in range(30)]
    bad = [(400, None, 1), (500, [1.0, NAN], 1), (600, [1.0, 1.0], None), (700, [INF, 1.0], 0), (800, [None, 1.0], 0), (None, [1.0, 1.0], 0)]
    other = [(900, [2.0, 1.0, 0.0], 0), (901, [1.0, 1.0, 1.0], 0), (902, [0.9, 0.5, 0.1], 1), (1000, [], 0), (1001, [], 0), (1002, [], 1), (1100, [0.0, 0.0], 2)]
    rows = copies + bad + other
    found = mined(spark, rows + copies[:5])
    assert found == brute_force(rows) and {r[0] for r in found} == {0, 200, 900, 1000, 1100}


def test_few_rows(spark):
    rows = vectors(3, 4, 1)
    assert mined(spark, rows[:1]) == [] and mined(spark, rows) == brute_force(rows)
    assert mined(spark, [(5, [1.0], 1)]) == []
    assert m.mine(given(spark, "embeddings").limit(0), F.col("vec_id") % 100 == 0, F.col("label")).collect() == []


def test_numbers_beyond_doubles(spark):
    rows = [(i, [float(np.float32(1e6 * ((i * 7) % 11 - 5))), 1.0 + i / 256, 3e6], i % 2) for i in range(101)]
    assert mined(spark, rows) == brute_force(rows)


def test_spanning_tree_is_minimal():
    rng = np.random.default_rng(2)
    x = np.floor(rng.normal(size=(40, 5)) * 256)
    order, parent, edge = m.spanning_tree(x)
    assert sorted(order) == list(range(40)) and parent[0] == -1 and all(parent[i] < i for i in range(1, 40))
    true = [np.linalg.norm(x[order[i]] - x[order[parent[i]]]) for i in range(1, 40)]
    assert np.allclose(edge[1:], true, rtol=1e-6) and all(e >= t for e, t in zip(edge[1:], true, strict=True))
    pairs = sorted((np.linalg.norm(x[i] - x[j]), i, j) for i in range(40) for j in range(i))
    root, total = list(range(40)), 0.0

    def top(i):
        return i if root[i] == i else top(root[i])

    for length, i, j in pairs:
        if top(i) != top(j):
            root[top(i)] = top(j)
            total += length
    assert np.isclose(sum(true), total)


def test_bounds_spare_scores():
    """With anchors close together most candidates are never scored with a child."""
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(4000, 16)) * 256)
    anchors = np.floor(x[:1] + rng.normal(size=(50, 16)) * 2)
    rows = pa.table({"id": np.arange(4000), "label": np.arange(4000) % 5, "v": list(x), "dim": [16] * 4000})
    block = m.Block.of(rows, 16)
    order, parent, edge = m.spanning_tree(anchors)
    for own in block.intervals(anchors[order], parent, edge):
        places, exact = own.best(block.labels == 1, 5)
        true = x @ own.vector
        assert (own.low <= true).all() and (own.high >= true).all()
        want = sorted((-true[i], i) for i in range(4000) if block.labels[i] == 1)[:5]
        assert [(-s, p) for p, s in zip(places, exact, strict=True)] == want
    assert block.scored < 0.2 * 50 * 4000
