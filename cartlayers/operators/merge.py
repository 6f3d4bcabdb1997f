"""Deduplicated tables that new rows are merged into, without reading or writing the whole table.

Rows are dealt into buckets by their key, and every bucket is a part of a stored table. The row that
`keep_first` keeps is a minimum, so the kept row of all rows is the kept one of the former kept row and
of those that are new: merging batches in any order, or one of them again, gives what deduplicating all
rows at once gives. A batch reads and replaces only buckets that one of its keys falls into.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartlayers.operators.dedup import keep_first
from cartlayers.sources.releases import Release, ReleaseStore, Stored

BUCKET = "_bucket"
#: Choose it so that a bucket is a few hundred MB when the table is as large as it gets.
BUCKETS = 64


@dataclass(frozen=True)
class Merged:
    """A new version of a table, not released yet, and the parts in which it differs."""

    stored: Stored
    touched: tuple[str, ...]


def bucket_of(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in key]), F.lit(buckets)).cast("int")


def merge_first(
    store: ReleaseStore,
    name: str,
    batch: DataFrame,
    key: Sequence[str],
    order: Sequence[str] = (),
    buckets: int = BUCKETS,
    base: Release | None = None,
) -> Merged:
    """Merge `batch` into the table `name` of the release `base`, by default the current one.

    `order` is that of `keep_first`. Key, order and number of buckets are those the table was made with;
    another key or order is an error. The batch has the table's columns, in any order. Commit the
    result with `based_on=base`, so that a merge by another run in between is noticed.
    """
    base = base or store.current()
    former = base.tables.get(name)
    rule = {"key": list(key), "order": list(order), "buckets": former.notes["buckets"] if former else buckets}
    if former:
        if dict(former.notes) != rule:
            raise ValueError(f"table '{name}' is kept by {dict(former.notes)}")
        batch = batch.select(former.struct.names)
    # Copies within the batch go first: map-side, so that a hot key is a row for each task.
    dealt = keep_first(batch, key, order).withColumn(BUCKET, bucket_of(key, rule["buckets"]))
    fresh = store.write_parts(dealt.repartition(BUCKET), f"{name}_batch", BUCKET)
    touched = tuple(sorted(fresh.parts))
    try:
        if former is None:
            return Merged(Stored(fresh.parts, fresh.format, fresh.schema, rule), touched)
        rows = merging(store, former, fresh, key, order, rule["buckets"])
        merged = store.write_parts(rows, name, BUCKET)
    except BaseException:
        store.discard([fresh])
        raise
    store.discard([fresh])
    return Merged(Stored({**former.parts, **merged.parts}, former.format, former.schema, rule), touched)


def merging(
    store: ReleaseStore, former: Stored, fresh: Stored, key: Sequence[str], order: Sequence[str], buckets: int
) -> DataFrame:
    """The rows of the touched buckets after the merge, from at most two rows per key."""
    both = store.open(former, fresh.parts).unionByName(store.open(fresh))
    # One shuffle, by bucket, serves both the comparison of keys and the write of buckets.
    dealt = both.withColumn(BUCKET, bucket_of(key, buckets)).repartition(BUCKET)
    ranking = order or [c for c in former.struct.names if c not in key]
    return keep_first(dealt, [BUCKET, *key], ranking or key)


def rewrite_parts(store: ReleaseStore, name: str, rows: DataFrame, key: Sequence[str], buckets: int) -> Stored:
    """Rows made from touched buckets, as parts of their own in the same buckets."""
    return store.write_parts(rows.withColumn(BUCKET, bucket_of(key, buckets)).repartition(BUCKET), name, BUCKET)


def append_part(store: ReleaseStore, name: str, batch: DataFrame, part: str, base: Release | None = None) -> Merged:
    """Add `batch` to the table `name` as the part `part`; a part that is there already stays as it is.

    So a batch that is written again after a failure is in the table once.
    """
    base = base or store.current()
    former = base.tables.get(name)
    if former and part in former.parts:
        return Merged(former, ())
    if former:
        batch = batch.select(former.struct.names)
    fresh = store.write(batch, name)
    parts = {**(former.parts if former else {}), part: next(iter(fresh.parts.values()))}
    return Merged(Stored(parts, fresh.format, former.schema if former else fresh.schema, dict(former.notes) if former else {}), (part,))


def changed_parts(before: Stored | None, after: Stored | None) -> list[str]:
    """Parts whose folders are not the same in two versions of a table."""
    old, new = (dict(t.parts) if t else {} for t in (before, after))
    return sorted(p for p in {*old, *new} if old.get(p) != new.get(p))


def changed_keys(before: DataFrame, after: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys of rows that two versions do not have equally often.

    Equal rows of both sides cancel out in one grouping by all columns.
    """
    columns = before.columns
    sides = before.withColumn("_side", F.lit(-1)).unionByName(after.select(columns).withColumn("_side", F.lit(1)))
    differing = sides.groupBy(*columns).agg(F.sum("_side").alias("_side")).where(F.col("_side") != 0)
    return differing.select(*key).distinct()
