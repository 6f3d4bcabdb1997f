"""Places of rows in a total order, found without bringing a group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartlayers.llm.common import stored


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows in ranges of `keys` (missing values first), stored, with two more columns.

    `part` numbers the ranges in order; `nth` is the place of a row in its range, from 0. Rows that
    agree in all keys stand in any order.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    part = F.spark_partition_id()
    nth = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    return stored(ranged.select("*", part.alias("part"), nth.alias("nth")))


def before(totals: DataFrame, measure: str, group: list[str]) -> DataFrame:
    """`totals`, a row for each part and group, with the sum of `measure` over the earlier parts as `base`.

    A group has at most as many rows as there are parts, however many rows they stand for.
    """
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("base", F.coalesce(F.sum(measure).over(earlier), F.lit(0)).cast("long"))


def placed(df: DataFrame, group: str, keys: list[str]) -> DataFrame:
    """Rows with `pos`, their place in their group in order of `keys`, from 0, and `n`, the group's rows.

    `group` has no missing values. A group of any size is spread over the ranges; only counts of
    (group, range) are put together, at most one for each group and each range.
    """
    rows = dealt(df, [group, *keys])
    counts = rows.groupBy(group, "part").agg(F.count("*").alias("rows"), F.min("nth").alias("first"))
    bases = before(counts, "rows", [group]).withColumn("n", F.sum("rows").over(Window.partitionBy(group)))
    found = rows.join(bases.select(group, "part", "first", "base", "n"), [group, "part"])
    return found.withColumn("pos", F.col("nth") - F.col("first") + F.col("base")).drop("part", "nth", "first", "base")
