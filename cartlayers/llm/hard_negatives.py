"""Hard negatives of anchors, found through bounds along a spanning tree of the anchors.

If a candidate's score with a parent anchor is known, its score with a child differs by at most the length
of the edge between the two anchors times the candidate's norm. So from the tree's root down every
candidate has an interval for its score, and only those whose interval can matter are scored again: for
positives those that may be among the best, for negatives those whose interval meets a window of a
positive and may be among its best. A score that was computed is an interval of no length; the others hand on
theirs, widened by the next edge.

Anchors are dealt into groups of some GROUP_ANCHORS, each with a minimum spanning tree of its own, and all rows
into blocks of some BLOCK_ROWS; a task holds one group and one block. Every block leaves a few best rows
per anchor, and the best of those are the result, so nothing depends on the blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartlayers.llm.common import prepared, stored, table

POSITIVES, NEGATIVES = 5, 10
#: Percent of the positive's score that a negative's score lies between.
LOW, HIGH = 30, 90
GROUP_ANCHORS, BLOCK_ROWS = 1024, 8192
#: Above this share of a block it is cheaper to score all of it.
DENSE = 0.25
#: Lengths are taken a little larger, by more than rounding can take from a bound of exact doubles.
SLACK = 1 + 1e-8
#: Whole numbers that doubles add up exactly.
EXACT = float(1 << 53)


def usable(rows: DataFrame, label: Column) -> DataFrame:
    """id, label, v (whole numbers, floor(256 x)) and dim, a row for each vec_id.

    Rows with a missing id, label, vector or component or one that is not finite take no part; of several rows
    with one id the one with the smallest label, then vector, counts. Numbers beyond 64 bits are cut to their
    ends. Other columns are left out.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    kept = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)))
    found = kept.select(F.col("vec_id").cast("long").alias("id"), label.cast("long").alias("label"), whole.alias("v"))
    one = found.where("label is not null").groupBy("id").agg(F.min(F.struct("label", "v")).alias("row"))
    return one.select("id", "row.label", "row.v", F.size("row.v").alias("dim"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows; of doubles where all their products are exact, else of Python's whole numbers."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)
    if dim and len(x) and float(np.abs(x).max()) ** 2 * dim * 4 >= EXACT:
        return np.array([[int(c) for c in row] for row in x], dtype=object).reshape(x.shape)
    return x


def scores(x: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Exact inner products."""
    if x.dtype == object or vector.dtype == object:
        return np.array([sum(int(a) * int(b) for a, b in zip(row, vector, strict=True)) for row in x], dtype=object)
    return x @ vector


def lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) * SLACK


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A minimum spanning tree of the rows: them in an order with parents first, the parents' places in it
    (-1 for the root) and the lengths of the edges."""
    n, points = len(x), x.astype(np.float64)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    nearest, via = np.full(n, np.inf), np.zeros(n, np.int64)
    outside = np.ones(n, bool)
    at = 0
    for place in range(n):
        order[place], outside[at] = at, False
        if place:
            parent[place], edge[place] = via[at], nearest[at]
        distance = lengths(points - points[at])
        closer = outside & (distance < nearest)
        nearest[closer], via[closer] = distance[closer], place
        at = int(np.argmin(np.where(outside, nearest, np.inf)))
    return order, parent, edge


def trees(anchors: DataFrame, groups: int) -> DataFrame:
    """`anchors` (id, label, v, dim) with their group, their place in its tree, their parent's and the edge."""

    def build(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        order, parent, edge = spanning_tree(matrix(rows.column("v"), rows.column("dim")[0].as_py()))
        taken = rows.take(pa.array(order))
        return pa.table([*taken.columns, pa.array(np.arange(len(order))), pa.array(parent), pa.array(edge)], names=[*taken.column_names, "place", "parent", "edge"])

    dealt = anchors.withColumn("group", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    schema = "id long, label long, v array<double>, dim int, group int, place long, parent long, edge double"
    return dealt.groupBy("dim", "group").applyInArrow(build, schema)


@dataclass
class Block:
    """The candidates of a task, in order of their ids."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    norms: np.ndarray
    scored: int = 0

    @staticmethod
    def of(rows: pa.Table, dim: int) -> Block:
        rows = rows.sort_by("id")
        x = matrix(rows.column("v"), dim)
        return Block(rows.column("id").to_numpy(), rows.column("label").to_numpy(), x, lengths(x))

    def inexact(self, vectors: np.ndarray) -> bool:
        return self.x.dtype == object or vectors.dtype == object

    def intervals(self, vectors: np.ndarray, parent: np.ndarray, edge: np.ndarray) -> Iterator[Interval]:
        """Bounds of the scores with every anchor of a tree, parents first."""
        children = np.bincount(parent[1:], minlength=len(parent)) if len(parent) else parent
        held: dict[int, Interval] = {}
        for place, vector in enumerate(vectors):
            if place:
                above = held[int(parent[place])]
                # no bounds beyond the numbers that doubles hold: every score is computed
                reach = np.where(self.inexact(vectors), np.inf, edge[place] * self.norms)
                own = Interval(self, vector, above.low - reach, above.high + reach)
                children[parent[place]] -= 1
                if not children[parent[place]]:
                    del held[int(parent[place])]
            else:
                infinite = np.full(len(self.ids), np.inf)
                own = Interval(self, vector, -infinite, infinite)
                own.score(np.ones(len(self.ids), bool))
            yield own
            if children[place]:
                held[place] = own


@dataclass
class Interval:
    """Where the scores of a block with one anchor lie."""

    block: Block
    vector: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def score(self, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of the candidates that are wanted, by place; they narrow the interval."""
        known = self.low == self.high
        new = np.flatnonzero(wanted & ~known)
        if len(new) > DENSE * len(known):
            new = np.arange(len(known))
        self.block.scored += len(new)
        if len(new):
            found = scores(self.block.x if len(new) == len(known) else self.block.x[new], self.vector)
            if found.dtype == object or self.low.dtype == object:
                self.low, self.high = self.low.astype(object), self.high.astype(object)
            self.low[new] = self.high[new] = found
        return np.flatnonzero(wanted)

    def best(self, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best allowed candidates, best first, ties by id."""
        if not allowed.any():
            return np.zeros(0, np.int64), np.zeros(0)
        places = self.score(allowed & (self.high >= self._least(allowed, k)))
        exact = self.low[places]
        order = np.argsort(-exact, kind="stable")[:k]
        return places[order], exact[order]

    def _least(self, allowed: np.ndarray, k: int) -> float:
        """A bound that the k-th best of the allowed candidates reaches."""
        lows = self.low[allowed]
        return np.sort(lows)[-k] if len(lows) >= k else -np.inf

    def within(self, allowed: np.ndarray, windows: list[tuple[int, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (100 times the least and the largest score) the k best allowed candidates in it."""
        wanted = np.zeros(len(allowed), bool)
        for least, most in windows:
            near = allowed & (self.high * 100 >= least) & (self.low * 100 <= most)
            # strictly, since rounding may make equal what is not
            sure = near & (self.low * 100 > least) & (self.high * 100 < most)
            wanted |= near & (self.high >= self._least(sure, k))
        places = self.score(wanted)
        exact, found = self.low[places], []
        exact = exact if exact.dtype == object else exact.astype(np.int64)
        for least, most in windows:
            inside = (exact * 100 >= least) & (exact * 100 <= most)
            order = np.argsort(-exact[inside], kind="stable")[:k]
            found.append((places[inside][order], exact[inside][order]))
        return found


def _long(value) -> int:
    """A score as a 64-bit number; what lies beyond is cut to its ends."""
    return max(min(int(value), (1 << 63) - 1), -(1 << 63))


def _met(blocks: DataFrame, tree: DataFrame, groups: int, count: int):
    """Every block of rows with every group of anchors of the same dimension."""
    rows = blocks.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    asked = tree.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(count - 1))))
    keys = ["dim", "group", "block"]
    return rows.groupBy(*keys).cogroup(asked.groupBy(*keys))


def _task(rows: pa.Table, asked: pa.Table) -> tuple[Block, pa.Table, Iterator[Interval]] | None:
    if not rows.num_rows or not asked.num_rows:
        return None
    dim = rows.column("dim")[0].as_py()
    block, asked = Block.of(rows, dim), asked.sort_by("place")
    vectors = matrix(asked.column("v"), dim)
    return block, asked, block.intervals(vectors, asked.column("parent").to_numpy(), asked.column("edge").to_numpy())


PAIRS = "anchor long, id long, score long"
TRIPLES = "anchor long, positive long, id long, positive_score long, score long"


def _positives(rows: pa.Table, asked: pa.Table) -> pa.Table:
    found: list[tuple] = []
    if task := _task(rows, asked):
        block, asked, intervals = task
        for own, anchor, label in zip(intervals, asked.column("id").to_pylist(), asked.column("label").to_pylist(), strict=True):
            places, exact = own.best((block.labels == label) & (block.ids != anchor), POSITIVES)
            found += [(anchor, int(block.ids[p]), _long(s)) for p, s in zip(places, exact, strict=True)]
    return _table(found, ["anchor", "id", "score"])


def _negatives(rows: pa.Table, asked: pa.Table) -> pa.Table:
    found: list[tuple] = []
    if task := _task(rows, asked):
        block, asked, intervals = task
        columns = [asked.column(c).to_pylist() for c in ("id", "label", "positives")]
        for own, anchor, label, positives in zip(intervals, *columns, strict=True):
            if not positives:
                continue
            windows = [(LOW * p["score"], HIGH * p["score"]) for p in positives]
            for p, (places, exact) in zip(positives, own.within(block.labels != label, windows, NEGATIVES), strict=True):
                found += [(anchor, p["id"], int(block.ids[i]), p["score"], _long(s)) for i, s in zip(places, exact, strict=True)]
    return _table(found, ["anchor", "positive", "id", "positive_score", "score"])


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=names)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", nth.cast("int")).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, label: Column) -> DataFrame:
    """Hard negatives of the anchors among `rows` (vec_id, embedding and others).

    An anchor's positives are its POSITIVES best other rows of its label, best first, ties by smaller id. A
    positive's negatives are the NEGATIVES best rows of other labels whose score lies between LOW and HIGH percent
    of the positive's. Output: anchor_id, positive_id, rank (from 1), negative_id, positive_score and
    negative_score; a positive without negatives has no row. Rows are compared with rows of the same
    dimension. See `usable` for rows that take no part; `is_anchor` is a condition on vec_id.
    """
    spark = prepared(rows.sparkSession)
    kept = stored(usable(rows, label))
    anchors = kept.withColumnRenamed("id", "vec_id").where(is_anchor).withColumnRenamed("vec_id", "id")
    total, asked = kept.count(), anchors.count()
    count, groups = max(-(-total // BLOCK_ROWS), 1), max(-(-asked // GROUP_ANCHORS), 1)
    blocks = kept.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(count)).cast("int"))
    tree = stored(trees(anchors, groups))
    best = _first(_met(blocks, tree, groups, count).applyInArrow(_positives, PAIRS), ["anchor"], POSITIVES)
    positives = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    judged = stored(tree.join(positives, tree.id == positives.anchor, "left").drop("anchor"))
    found = _met(blocks, judged, groups, count).applyInArrow(_negatives, TRIPLES)
    return _first(found, ["anchor", "positive"], NEGATIVES).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors are the rows whose id 100 divides; where 7 divides it, the label first becomes the next of ten."""
    rows = table(spark, folder, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows, F.col("vec_id") % 100 == 0, label)


#: All pairs of an anchor and a row.
HARD_NEGATIVES_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id <> r.vec_id AND len(a.v) = len(r.v) WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), negatives AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM positives p JOIN pairs n ON n.anchor_id = p.anchor_id AND NOT n.same
    AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 10
"""
