"""References between tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows without a parent. A missing reference has no parent either, so it is returned."""
    keys = parent.select(F.col(parent_key).alias("_parent_key"))
    return child.join(keys, F.col(column) == F.col("_parent_key"), "left_anti")


def with_matches(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left outer join of a table with unique keys and a table of many rows per key.

    Written as the matches plus the left rows without any. Adaptive execution can split a hot key
    of the right side in an inner join but not in a left outer one, and the second part needs the
    right side only as distinct keys, which combine on the map side.
    """
    matches = left.join(right, key)
    alone = orphans(left, key, right.select(key).distinct(), key)
    return matches.unionByName(alone, allowMissingColumns=True)


def orphan_count(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """One row: the number of orphans.

    References are counted per value before the join. Equal values combine on the map side, so a
    value that most children share crosses the network once per task, and the join meets each
    value once on the partitioning the grouping already made.
    """
    per_value = child.groupBy(column).agg(F.count(F.lit(1)).alias("children"))
    return orphans(per_value, column, parent, parent_key).agg(
        F.coalesce(F.sum("children"), F.lit(0)).alias("orfaos")
    )
