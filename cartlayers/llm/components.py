"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartlayers.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of every node to the smallest of them and itself.

    `large`: only neighbours greater than the node; otherwise only smaller ones and the node. Both
    keep the components. The smallest neighbour comes from an aggregate, so a node with very many
    neighbours is combined before the shuffle and only meets it again in a join, which Spark can split.
    """
    if large:
        sides = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = sides.join(least, "a")
    if large:
        moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
    return moved.where(F.col("a") != F.col("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller one at most, and then none to it: the stars are done."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.agg(F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()[0] == 0


def connected_components(edges: DataFrame) -> DataFrame:
    """For edges (a, b): every node that has an edge, with the smallest node it can reach, as (node, label).

    Every round is written to the shared folder. It ends when the edges are stars around their smallest
    nodes, which further rounds would not change.
    """
    down = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current = stored(down.distinct())
    while not _settled(current):
        current = stored(_stars(_stars(current, large=True), large=False))
    labels = current.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("label"))
    return labels.unionByName(roots)
