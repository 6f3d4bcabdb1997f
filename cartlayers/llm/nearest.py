"""Approximate search for the largest inner products, by stable projections in a kd-tree.

A vector x, scaled by the largest norm, gets one more component that makes it a unit vector; a query
gets a zero there. The nearest such points are those with the largest inner products. A few Gaussian
(2-stable) projections turn squared distances into chi-square variables: for a point at distance d,
the squared distance of its projection is d^2 times a chi-square variable of as many degrees of freedom.

The projected points are cut into cells by the top of a kd-tree, whose splits come from a bounded
sample; every point is in a cell. In a cell, leaves of a kd-tree are visited in order of their projected
distance, their points verified with the true product, until the chi-square test says that with
probability STOP no closer point would project that far. A query first visits its own cell; the bound
found there tells by the same test which other cells it has to visit.

Equal vectors are one point with their smallest ids, as many as can be among the nearest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartlayers.llm.common import map_tables, stored, table
from cartlayers.llm.words import randoms

K = 20
PROJECTIONS = 8
STOP = 0.99
CELL_ROWS = 8192
LEAF_ROWS = 256
#: Splits come from at most so many points per cell, and in all.
SAMPLE_PER_CELL, MOST_SAMPLED = 64, 400_000
QUERIES_TOGETHER = 4096


def gaussian(rows: int, columns: int, seed: int = 31) -> np.ndarray:
    """The same normal variables on every machine."""
    u = (randoms(2 * rows * columns, seed) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    u = u.reshape(2, rows, columns)
    return np.sqrt(-2 * np.log1p(-u[0])) * np.cos(2 * math.pi * u[1])


def chi_square_below(x: np.ndarray) -> np.ndarray:
    """Distribution function for PROJECTIONS (even) degrees of freedom."""
    half = np.asarray(x, dtype=np.float64) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, PROJECTIONS // 2):
        term = term * half / i
        total = total + term
    with np.errstate(over="ignore", invalid="ignore"):
        return np.where(np.isfinite(half), 1 - np.exp(-half) * total, 1.0)


def vectors(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


@dataclass(frozen=True)
class Space:
    """Projection of vectors of one dimension whose norms are at most `largest`."""

    dimension: int
    largest: float

    def points(self, x: np.ndarray) -> np.ndarray:
        scaled = x / self.largest
        rest = np.sqrt(np.maximum(0.0, 1 - (scaled**2).sum(axis=1)))
        return np.concatenate([scaled, rest[:, None]], axis=1)

    def queries(self, q: np.ndarray) -> np.ndarray:
        unit = q / np.linalg.norm(q, axis=1)[:, None]
        return np.concatenate([unit, np.zeros((len(q), 1))], axis=1)

    def project(self, points: np.ndarray) -> np.ndarray:
        return points @ gaussian(self.dimension + 1, PROJECTIONS)


@dataclass(frozen=True)
class Splits:
    """A complete binary tree of cuts, the node's children at 2i + 1 and 2i + 2; cells are its leaves."""

    axis: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(sample: np.ndarray, cells: int) -> Splits:
        depth = max(0, math.ceil(math.log2(max(1, cells))))
        axis, value = np.zeros((1 << depth) - 1, dtype=np.int64), np.zeros((1 << depth) - 1)
        parts = {0: sample}
        for node in range(len(axis)):
            part = parts.pop(node)
            spread = part.max(axis=0) - part.min(axis=0) if len(part) else np.zeros(PROJECTIONS)
            axis[node] = int(spread.argmax())
            value[node] = float(np.median(part[:, axis[node]])) if len(part) else 0.0
            below = part[:, axis[node]] < value[node]
            parts[2 * node + 1], parts[2 * node + 2] = part[below], part[~below]
        return Splits(axis, value)

    def cell(self, projected: np.ndarray) -> np.ndarray:
        node = np.zeros(len(projected), dtype=np.int64)
        while len(node) and node[0] < len(self.axis):
            right = projected[np.arange(len(node)), self.axis[node]] >= self.value[node]
            node = 2 * node + 1 + right
        return node - len(self.axis)


def _box_gap(low: np.ndarray, high: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distance from each place to each box."""
    gap = np.maximum(0.0, np.maximum(low[None] - at[:, None], at[:, None] - high[None]))
    return (gap**2).sum(axis=2)


class Tree:
    """The points of a cell in kd order, in leaves of about LEAF_ROWS with their boxes."""

    def __init__(self, projected: np.ndarray):
        order, ready = [np.arange(len(projected))], []
        while order:
            part = order.pop()
            if len(part) <= LEAF_ROWS:
                ready.append(part)
                continue
            own = projected[part]
            axis = int((own.max(axis=0) - own.min(axis=0)).argmax())
            ranked = part[np.argsort(own[:, axis], kind="stable")]
            order += [ranked[: len(ranked) // 2], ranked[len(ranked) // 2 :]]
        self.leaves = ready
        self.low = np.array([projected[x].min(axis=0) for x in ready])
        self.high = np.array([projected[x].max(axis=0) for x in ready])


def search(space: Space, x: np.ndarray, ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int):
    """For each query, the k best points of a cell as positions (-1: none) and their products.

    `bound` is a squared distance beyond which nothing is wanted. Ties go to the smaller id.
    """
    points = space.points(x)
    projected, queries = space.project(points), space.queries(q)
    tree = Tree(projected)
    norms = np.linalg.norm(q, axis=1)
    gaps = _box_gap(tree.low, tree.high, space.project(queries))
    turn = np.argsort(gaps, axis=1, kind="stable")
    best = np.full((len(q), k), -np.inf)
    held = np.full((len(q), k), -1, dtype=np.int64)
    reach, active = bound.copy(), np.arange(len(q))
    for step in range(len(tree.leaves)):
        leaf = turn[active, step]
        with np.errstate(divide="ignore", invalid="ignore"):
            done = chi_square_below(gaps[active, leaf] / reach[active]) >= STOP
        active, leaf = active[~done], leaf[~done]
        if not len(active):
            break
        for number in np.unique(leaf):
            who, members = active[leaf == number], tree.leaves[number]
            products = np.concatenate([best[who], q[who] @ x[members].T], axis=1)
            places = np.concatenate([held[who], np.broadcast_to(members, (len(who), len(members)))], axis=1)
            tie = np.where(places >= 0, ids[places], np.iinfo(np.int64).max)
            pick = np.lexsort((tie, -products), axis=1)[:, :k]
            best[who] = np.take_along_axis(products, pick, axis=1)
            held[who] = np.take_along_axis(places, pick, axis=1)
            # squared distance of unit vectors whose product is best / (|q| * largest)
            with np.errstate(invalid="ignore"):
                own = 2 - 2 * best[who, -1] / (norms[who] * space.largest)
            reach[who] = np.minimum(reach[who], np.where(np.isfinite(own), np.maximum(own, 1e-12), np.inf))
    return held, reach


def _found(space: Space, points: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    x, q = vectors(points.column("vector")), vectors(queries.column("vector"))
    ids, own = points.column("id").to_numpy(), queries.column("id").to_numpy()
    if not len(x) or not len(q):
        return pa.table({"query": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "reach": pa.array([], pa.float64())})
    held, reach = search(space, x, ids, q, queries.column("reach").to_numpy(), k)
    row, _ = np.nonzero(held >= 0)
    place = held[held >= 0]
    score = (q[row] * x[place]).sum(axis=1)
    return pa.table({"query": own[row], "id": ids[place], "score": score, "reach": reach[row]})


FOUND = "query long, id long, score double, reach double"


def usable(table: DataFrame) -> DataFrame:
    """(vec_id, vector): rows with an id and a finite vector that is not zero, of the usual dimension.

    The usual dimension is the most frequent one, of equally frequent ones the largest. A repeated row counts once.
    """
    x = F.col("embedding")
    fine = table.where(
        F.col("vec_id").isNotNull()
        & x.isNotNull()
        & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        & F.exists(x, lambda v: v != 0)
    ).select("vec_id", F.transform(x, lambda v: v.cast("double")).alias("vector"))
    sizes = fine.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return fine.where(F.size("vector") == (sizes["size"] if sizes else 0))


def nearest(embeddings: DataFrame, is_query, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: for every query row its k nearest other rows.

    `embeddings` has vec_id and embedding; `is_query` is a condition on vec_id. Rows that `usable` leaves
    out are neither queries nor found. Ties go to the smaller vec_id. Fewer than k others give fewer
    rows; an empty table gives none. Other columns are ignored.
    """
    key = F.struct(F.xxhash64("vector").alias("a"), F.hash("vector").alias("b"), F.element_at("vector", 1).alias("c"))
    rows = usable(embeddings).withColumn("key", key)
    order = Window.partitionBy("key").orderBy("vec_id")
    # of equal vectors only the k + 1 smallest ids can be found; all of them can be queries
    nth = rows.select("key", "vec_id").withColumn("nth", F.dense_rank().over(order)).where(F.col("nth") <= k + 1)
    copies = stored(nth.select("key", "vec_id").distinct())
    classes = stored(
        rows.groupBy("key").agg(
            F.min("vec_id").alias("id"), F.any_value("vector").alias("vector"), F.max(is_query).alias("asked")
        )
    )
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, v: total + v * v))
    facts = classes.agg(F.count("*").alias("n"), F.max(norm).alias("largest"), F.max(F.size("vector")).alias("size")).first()
    if not facts.n:
        return embeddings.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    space = Space(facts["size"], float(facts.largest))
    cells = -(-facts.n // CELL_ROWS)
    share = min(1.0, min(MOST_SAMPLED, SAMPLE_PER_CELL * cells * 16) / facts.n)
    sample = classes.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("vector").toArrow()
    splits = Splits.of(space.project(space.points(vectors(sample.column("vector")))), cells)

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = vectors(batch.column("vector"))
        own = splits.cell(space.project(space.points(x)))
        asked = splits.cell(space.project(space.queries(x)))
        projected = pa.FixedSizeListArray.from_arrays(pa.array(space.project(space.points(x)).ravel()), PROJECTIONS)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("vector"), batch.column("asked"), pa.array(own), pa.array(asked), projected.cast(pa.list_(pa.float64()))],
            ["id", "vector", "asked", "cell", "home", "projected"],
        )

    placed = stored(
        map_tables(
            classes.select("id", "vector", "asked"),
            place,
            "id long, vector array<double>, asked boolean, cell long, home long, projected array<double>",
        )
    )
    points = placed.select("cell", "id", "vector")
    queries = placed.where("asked").select("id", "vector", "home")
    homes = queries.select(F.col("home").alias("cell"), "id", "vector", F.lit(float("inf")).alias("reach"))
    first = stored(_visit(space, points, homes, k + 1))
    bounds = first.groupBy("query").agg(F.min("reach").alias("reach"), F.count("*").alias("n"))
    bounds = bounds.select("query", F.when(F.col("n") > k, F.col("reach")).otherwise(float("inf")).alias("reach"))
    waiting = queries.join(bounds, queries.id == bounds["query"], "left").select(
        "id", "vector", "home", F.coalesce("reach", F.lit(float("inf"))).alias("reach")
    )
    second = _visit(space, points, _other_cells(space, waiting, _boxes(placed)), k + 1)
    return _ranked(first.unionByName(second), copies, classes, rows, is_query, k)


def _boxes(placed: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells with points, and the smallest box of each; a few numbers per CELL_ROWS points."""
    ends = [f(F.element_at("projected", i + 1)).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(PROJECTIONS)]
    found = placed.groupBy("cell").agg(*ends).toArrow()
    low, high = (np.stack([found.column(f"{n}{i}").to_numpy() for i in range(PROJECTIONS)], axis=1) for n in ("low", "high"))
    return found.column("cell").to_numpy(), low, high


def _other_cells(space: Space, waiting: DataFrame, boxes: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """A row for every further cell that a query has to visit."""
    cells, low, high = boxes

    def spread(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            q = vectors(part.column("vector"))
            reach = part.column("reach").to_numpy()
            gaps = _box_gap(low, high, space.project(space.queries(q)))
            go = chi_square_below(gaps / reach[:, None]) < STOP
            go &= cells[None] != part.column("home").to_numpy()[:, None]
            row, cell = np.nonzero(go)
            taken = part.take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells[cell]), taken.column("id"), taken.column("vector"), taken.column("reach")],
                ["cell", "id", "vector", "reach"],
            )

    return map_tables(waiting, spread, "cell long, id long, vector array<double>, reach double")


def _visit(space: Space, points: DataFrame, visits: DataFrame, k: int) -> DataFrame:
    """What queries find in the cells they visit; many queries of a cell are dealt into blocks."""
    visits = stored(visits)
    blocks = visits.groupBy("cell").agg(F.ceil(F.count("*") / QUERIES_TOGETHER).cast("int").alias("blocks"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    spread = points.join(blocks, "cell").select("cell", every, "id", "vector")
    asked = visits.join(blocks, "cell").select(
        "cell", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"), "id", "vector", "reach"
    )

    def look(a: pa.Table, b: pa.Table) -> pa.Table:
        return _found(space, a, b, k)

    return spread.groupBy("cell", "block").cogroup(asked.groupBy("cell", "block")).applyInArrow(look, FOUND)


def _ranked(found: DataFrame, copies: DataFrame, classes: DataFrame, rows: DataFrame, is_query, k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    best = found.drop("reach").distinct().withColumn("nth", nth).where(F.col("nth") <= k + 1)
    keys = classes.select("key", "id")
    expanded = best.join(keys, "id").join(copies, "key").select("query", "score", "vec_id")
    nth = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    top = expanded.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    answer = top.groupBy("query").agg(
        F.sort_array(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("near")
    )
    by_key = answer.join(keys, F.col("query") == F.col("id")).select("key", "near")
    own = rows.where(is_query).select("key", F.col("vec_id").alias("query_id")).distinct().join(by_key, "key")
    others = F.slice(F.filter("near", lambda x: x.vec_id != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(others).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score"
    )


def op2_nearest(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
