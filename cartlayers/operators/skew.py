"""Left outer joins with keys that hold a large share of one side."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

#: A key with this share of the rows is heavy: on a thousand tasks it is ten times an even share.
HEAVY_SHARE = 0.01
#: Items that a sketch tracks; its estimates are off by at most about 3.5 / TRACKED of the rows.
TRACKED = 4096
#: Parts of a heavy key per shuffle partition. With several, their sum per task is even.
PARTS_PER_TASK = 16

_PART, _THERE = "_part_of_key", "_has_match"


def _sketch(column: str, share: float) -> Column:
    return F.expr(f"approx_top_k(CAST(`{column}` AS STRING), {int(1 / share)}, {TRACKED})")


def _heavy(items: Sequence, rows: int, share: float) -> list[str]:
    return sorted(i["item"] for i in items or [] if i["item"] is not None and i["count"] >= share * rows)


def heavy_keys(df: DataFrame, column: str, share: float = HEAVY_SHARE) -> list[str]:
    """Keys of about `share` of the rows or more, as text; at most 1 / share of them.

    A frequent-items sketch of fixed size per task finds them in one pass over the column.
    """
    found = df.agg(_sketch(column, share).alias("top"), F.count(column).alias("rows")).first()
    return _heavy(found["top"], found["rows"], share)


def observed_heavy_keys(
    df: DataFrame, columns: Sequence[str], share: float = HEAVY_SHARE
) -> tuple[DataFrame, Callable[[], Mapping[str, list[str]]]]:
    """`df`, whose next action also sketches the columns, and a function that then gives their heavy keys.

    For tables that are written anyway: the keys cost no pass of their own.
    """
    seen = Observation()
    measures = [m for c in columns for m in (_sketch(c, share).alias(f"top {c}"), F.count(c).alias(f"rows {c}"))]

    def keys() -> dict[str, list[str]]:
        found = seen.get
        return {c: _heavy(found[f"top {c}"], found[f"rows {c}"], share) for c in columns}

    return df.observe(seen, *measures), keys


def left_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    heavy: Sequence[str] | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left outer join on `key` of two sides of which `right` may have heavy keys, each side read once.

    The rows of a heavy key are dealt into parts by a hash of the columns `spread_by` (all, if not
    given), and the left rows with that key meet every part; all other rows are joined as they are. A
    heavy key is one that `right` has, so a left row that meets no row in a part is not an unmatched one
    and goes. `heavy` are keys as `heavy_keys(right, key)` gives them, which is asked if they are not
    given; others than those make the join slower or, if `right` lacks one, drop left rows that have it.
    """
    heavy = heavy_keys(right, key) if heavy is None else list(heavy)
    if not heavy:
        return left.join(right, key, "left")
    parts = PARTS_PER_TASK * int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def is_heavy(column: Column) -> Column:
        return F.coalesce(column.cast("string").isin(heavy), F.lit(False))

    spread = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by or right.columns]), F.lit(parts)).cast("int")
    dealt = right.withColumns({_PART: F.when(is_heavy(F.col(key)), spread).otherwise(0), _THERE: F.lit(True)})
    every = F.when(is_heavy(F.col(key)), F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    met = left.withColumn(_PART, F.explode(every)).join(dealt, [key, _PART], "left")
    return met.where(F.col(_THERE).isNotNull() | ~is_heavy(F.col(key))).drop(_PART, _THERE)
