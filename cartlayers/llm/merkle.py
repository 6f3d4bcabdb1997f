"""A dataset manifest: a Merkle tree over every group's rows, and one over the groups.

Slot pivot. Conditional aggregates over the children of a parent spread their digests into as many
columns as the tree has children per node; all columns together are the parent's input, and all but a
child's own are its siblings, those before it and those after it.

Levels are climbed LEVELS at a time: rows are shuffled once by their ancestor that many levels up, and
within it the parents of all levels are window partitions, each a prefix of the one sort order. A group
of any size is as many shuffle keys as it has such ancestors. Only the ancestors' digests go on to the
next round; on the way down each brings the rest of the path to the rows below it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartlayers.llm.common import stored, table
from cartlayers.llm.order import placed

FANOUT = 3
#: Levels that one shuffle serves.
LEVELS = 5
PATH = "array<struct<left:string,right:string>>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes in front, so that no two rows have the same input; `-` if missing."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_of(values: Sequence[Column]) -> Column:
    return digest(F.concat(*[field(v) for v in values]))


def climb(nodes: DataFrame) -> DataFrame:
    """`nodes` (tree, pos, n, digest and others) with `block`, `low` and `top`.

    `block` is the ancestor LEVELS up, `top` its digest and `low` the path to it. n is the number of the
    tree's nodes on this level; above its root a tree has no levels, and the digest stays.
    """
    ups = [f"up{i}" for i in range(LEVELS + 1)]
    rows = nodes.withColumns({u: F.expr(f"pos div {FANOUT**i}L") for i, u in enumerate(ups)})
    rows = rows.withColumnRenamed(ups[-1], "block").repartition("tree", "block")
    ups[-1] = "block"
    steps = []
    for level in range(LEVELS):
        family = Window.partitionBy("tree", *reversed(ups[level + 1 :]))
        slot = F.pmod(F.col(ups[level]), F.lit(FANOUT))
        columns = {f"slot{j}": F.max(F.when(slot == j, F.col("digest"))).over(family) for j in range(FANOUT)}
        rows = rows.withColumns(columns)
        inner = F.col("n") > FANOUT**level
        left = F.concat_ws("", *[F.when(slot > j, F.col(f"slot{j}")) for j in range(FANOUT)])
        right = F.concat_ws("", *[F.when(slot < j, F.col(f"slot{j}")) for j in range(FANOUT)])
        steps.append(f"step{level}")
        rows = rows.withColumns(
            {
                steps[-1]: F.when(inner, F.struct(left.alias("left"), right.alias("right"))),
                "digest": F.when(inner, digest(F.concat_ws("", *columns))).otherwise(F.col("digest")),
            }
        ).drop(*columns)
    low = F.array_compact(F.array(*steps)).cast(PATH)
    return rows.withColumn("low", low).withColumnRenamed("digest", "top").drop(*steps, *ups[:-1])


def rooted(nodes: DataFrame, largest: int, ending: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`nodes` with `path` to their root, and what `ending` says about the root of their tree.

    `ending` gets (tree, digest), a row for each tree, and returns tree, `path` and other columns.
    `largest` is the number of nodes of the largest tree.
    """
    if largest <= 1:
        return nodes.join(ending(nodes.select("tree", "digest")), "tree").drop("digest", "n", "pos")
    climbed = climb(nodes)
    size = FANOUT**LEVELS
    heads = climbed.where(F.col("pos") % size == 0).select(
        "tree", F.col("block").alias("pos"), F.expr(f"(n + {size - 1}L) div {size}L").alias("n"),
        F.col("top").alias("digest"), F.col("block").alias("head"),
    )
    above = rooted(stored(heads), -(-largest // size), ending).withColumnRenamed("head", "block")
    found = climbed.drop("top", "n", "pos").join(above, ["tree", "block"]).drop("block")
    return found.withColumn("path", F.concat("low", "path")).drop("low")


def largest_tree(nodes: DataFrame) -> int:
    return nodes.agg(F.max("n")).first()[0] or 0


def manifest(leaves: DataFrame, order: Sequence[str]) -> DataFrame:
    """`leaves` (group, leaf and others) with `path`, `subroot` and `root`; `leaf` stays.

    Leaves stand in order of the columns `order`, missing values first, then of their digests; equal
    rows are leaves each. Groups stand in order of their bytes, the missing one first; an empty group
    is not the missing one. A group's only leaf is its subroot, an only subroot is the root. No rows give none.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit(""))
    nodes = placed(leaves.withColumn("tree", tree), "tree", [*order, "leaf"]).withColumn("digest", F.col("leaf"))

    def over_groups(subroots: DataFrame) -> DataFrame:
        heads = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("member"), "digest")
        heads = placed(heads, "tree", ["member"]).withColumn("subroot", F.col("digest"))
        found = rooted(heads, largest_tree(heads), only_root)
        return found.select(F.col("member").alias("tree"), "path", "subroot", "root")

    return rooted(nodes, largest_tree(nodes), over_groups).drop("tree")


def only_root(root: DataFrame) -> DataFrame:
    return root.select("tree", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))


def folded(path: Column, leaf: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda node, step: digest(F.concat(step["left"], node, step["right"])))


def siblings(path: Column) -> Column:
    """All digests of a path, from the leaf's level up."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def audited(
    docs: DataFrame, columns: Sequence[str], key: str, group: str, changes: Mapping[str, Column]
) -> DataFrame:
    """Every row's place in the manifest, and whether the row still leads there after `changes`.

    Output: the column `key`, leaf, subroot, root and proof_sha256 (the digest of the siblings, level by
    level) of the original rows; folded_root, from the changed row and the original siblings; verified,
    whether that is the root. One row for each row; missing values are part of the leaf; other columns
    are left out. An empty table gives no rows.
    """
    after = [changes.get(c, F.col(c)) for c in columns]
    leaves = docs.select(
        F.col(key).alias("key"), F.col(group).cast("string").alias("group"),
        leaf_of([F.col(c) for c in columns]).alias("leaf"), leaf_of(after).alias("after"),
    )
    found = manifest(stored(leaves), ["key"]).withColumn("folded_root", folded(F.col("path"), F.col("after")))
    return found.select(
        F.col("key").alias(key), "leaf", "subroot", "root", digest(siblings(F.col("path"))).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: The columns of a leaf, in order.
LEAF_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """All documents by source; those whose id has an even checksum lose the line breaks of their text."""
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    unbroken = F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return audited(table(spark, folder, "documents"), LEAF_COLUMNS, "doc_id", "source", {"text": unbroken})


#: The same level by level; crc32 is worked out from its polynomial.
MERKLE_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT *, CASE WHEN (list_reduce(list_transform(range(1, length(CAST(doc_id AS VARCHAR)) + 1),
      lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER), 1)) AS BIGINT)),
      lambda c, b: list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
      4294967295) & 1) = 1 THEN replace(text, chr(10), '') ELSE text END AS later
  FROM documents
), heads AS (
  SELECT doc_id, source, text, later,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head
  FROM docs
), leaves AS (
  SELECT doc_id, source, coalesce('=' || source, '') AS tree,
    sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(later) || ':' || later, '-')) AS after
  FROM heads
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM leaves
), nodes AS (
  SELECT tree, CAST(0 AS BIGINT) AS level, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT tree, level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 3
), subroots AS (
  SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1
), overs AS (
  SELECT CAST(0 AS BIGINT) AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM overs WHERE n > 1 GROUP BY level, pos // 3
), low_steps AS (
  SELECT p.tree, p.pos AS leaf_pos, k.level,
    coalesce(string_agg(k.digest, '' ORDER BY k.pos) FILTER (WHERE k.pos < p.pos // CAST(3 ** k.level AS BIGINT)), '') AS before,
    coalesce(string_agg(k.digest, '' ORDER BY k.pos) FILTER (WHERE k.pos > p.pos // CAST(3 ** k.level AS BIGINT)), '') AS behind
  FROM placed p JOIN nodes k ON k.tree = p.tree AND k.n > 1 AND k.pos // 3 = p.pos // CAST(3 ** (k.level + 1) AS BIGINT)
  GROUP BY p.tree, p.pos, k.level
), high_steps AS (
  SELECT s.tree, k.level,
    coalesce(string_agg(k.digest, '' ORDER BY k.pos) FILTER (WHERE k.pos < s.pos // CAST(3 ** k.level AS BIGINT)), '') AS before,
    coalesce(string_agg(k.digest, '' ORDER BY k.pos) FILTER (WHERE k.pos > s.pos // CAST(3 ** k.level AS BIGINT)), '') AS behind
  FROM subroots s JOIN overs k ON k.n > 1 AND k.pos // 3 = s.pos // CAST(3 ** (k.level + 1) AS BIGINT)
  GROUP BY s.tree, k.level
), low AS (
  SELECT tree, leaf_pos, list({'before': before, 'behind': behind} ORDER BY level) AS steps FROM low_steps GROUP BY tree, leaf_pos
), high AS (
  SELECT tree, list({'before': before, 'behind': behind} ORDER BY level) AS steps FROM high_steps GROUP BY tree
), paths AS (
  SELECT p.doc_id, p.leaf, p.after, s.subroot, list_concat(coalesce(l.steps, []), coalesce(h.steps, [])) AS steps
  FROM placed p JOIN subroots s ON s.tree = p.tree
  LEFT JOIN low l ON l.tree = p.tree AND l.leaf_pos = p.pos LEFT JOIN high h ON h.tree = p.tree
), folds AS (
  SELECT *, (SELECT digest FROM overs WHERE n = 1) AS root,
    list_reduce(list_prepend({'before': after, 'behind': ''}, steps),
      lambda a, s: {'before': sha256(s.before || a.before || s.behind), 'behind': ''}).before AS folded_root
  FROM paths
)
SELECT doc_id, leaf, subroot, root,
  sha256(array_to_string(list_transform(steps, lambda s: s.before || s.behind), '')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM folds
"""
