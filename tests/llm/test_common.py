from __future__ import annotations

import re
from pathlib import Path

import numpy as np
import pyarrow as pa

from cartlayers.llm import common as m


def test_shared_folders_are_removed_on_request(spark):
    before = list(m._folders)
    m._folders.clear()
    kept = m.stored(spark.range(5))
    folder = Path(m._folders[0].removeprefix("file:"))
    assert kept.count() == 5 and folder.exists()
    assert m.remove_shared(spark) == 1 and not folder.exists() and not m._folders
    m._folders.extend(before)


def held() -> float:
    """MB of this process, without mapped files."""
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def fragments() -> np.ndarray:
    """Some 100 MB in pieces; what is left lies above them, so that the C library keeps what they held."""
    pieces = [np.ones(8_000) for _ in range(1_600)]
    last = np.ones(8_000)
    del pieces
    return last


def test_freed_memory_is_given_back():
    m.give_back()
    before, last = held(), fragments()
    m.give_back()
    assert last.size and held() < before + 30


class Batches:
    """Stands for a DataFrame whose one task runs here."""

    def __init__(self, *batches: pa.RecordBatch):
        self.batches = batches

    def mapInArrow(self, run, schema):
        return list(run(iter(self.batches)))


def test_tasks_give_back_what_they_freed():
    batch, last = pa.RecordBatch.from_pydict({"n": [1, 2]}), []

    def work(given):
        last.append(fragments())
        yield given

    m.give_back()
    before = held()
    assert m.map_tables(Batches(batch, batch), work, "n long") == [batch, batch]
    assert len(last) == 2 and held() < before + 30
