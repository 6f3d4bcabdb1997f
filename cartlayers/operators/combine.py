"""Union of many small frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, joined in pairs so that the plan stays shallow with many frames."""
    level = list(frames)
    while len(level) > 1:
        pairs = [level[i : i + 2] for i in range(0, len(level), 2)]
        level = [p[0].unionByName(p[1]) if len(p) == 2 else p[0] for p in pairs]
    return level[0]
