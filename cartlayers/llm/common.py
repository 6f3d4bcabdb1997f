"""What the operators share: tables of a folder, stored intermediate results, Arrow batches."""

from __future__ import annotations

import ctypes
import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlayers.session import pin_semantics


#: Rows of a batch that Python workers get; texts are long, and a batch is held several times.
BATCH_ROWS = 2000
#: Bytes of a file that go to the JVM at once; they are held several times on the way.
SENT_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def prepared(spark: SparkSession) -> SparkSession:
    """The session with its semantics pinned and this package importable by its Python workers."""
    context = spark.sparkContext
    if not getattr(context, "_cartlayers_sent", False):
        packed = io.BytesIO()
        root = Path(__file__).resolve().parents[1]
        with zipfile.ZipFile(packed, "w") as archive:
            for file in sorted(root.rglob("*.py")):
                archive.write(file, file.relative_to(root.parent))
        context.addPyFile(share_file(spark, "cartlayers.zip", packed.getvalue()))
        context._cartlayers_sent = True
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return pin_semantics(spark)


def share_file(spark: SparkSession, name: str, content: bytes) -> str:
    """Write a file to the shared folder through Hadoop's file systems; its URI."""
    java = spark.sparkContext._jvm
    path = java.org.apache.hadoop.fs.Path(shared_folder(spark), name)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = system.create(path)
    try:
        for start in range(0, len(content), SENT_BYTES):
            out.write(bytearray(content[start : start + SENT_BYTES]))
    finally:
        out.close()
    return system.makeQualified(path).toString()


#: Shared folders that this process has named.
_folders: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, or below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    _folders.append(f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}")
    return _folders[-1]


def remove_shared(spark: SparkSession) -> int:
    """Delete the shared folders of this process; results that were not stored elsewhere are gone then.

    Call it last, when the results of all queries are written: executors that start later would look for
    the files in them. Returns how many folders there were.
    """
    java, removed = spark.sparkContext._jvm, 0
    while _folders:
        path = java.org.apache.hadoop.fs.Path(_folders.pop())
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        removed += bool(system.delete(path, True))
    return removed


def stored(df: DataFrame) -> DataFrame:
    """The rows of `df`, written to the shared folder and read back: computed once, no lineage."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class SharedArrays:
    """Arrays that tasks map into memory from files which Spark copies to every executor once."""

    files: dict[str, str]

    @staticmethod
    def send(spark: SparkSession, **arrays: np.ndarray) -> SharedArrays:
        files = {}
        for name, array in arrays.items():
            content = io.BytesIO()
            np.save(content, array)
            files[name] = f"{name}-{uuid.uuid4().hex}.npy"
            spark.sparkContext.addFile(share_file(spark, files[name], content.getvalue()))
        return SharedArrays(files)

    def open(self) -> dict[str, np.ndarray]:
        return {name: np.load(SparkFiles.get(file), mmap_mode="r") for name, file in self.files.items()}


def give_back() -> None:
    """Hand the memory that this process has freed back to the system, where the C library can.

    The driver lives as long as the session, and a worker runs many tasks: what one step or task has freed
    would count through all later ones.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def giving_back(run: Callable) -> Callable:
    """`run`, a function that yields batches, with its worker's memory given back at the end of a task or group."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return whole


def map_tables(df: DataFrame, function: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply `function` to each Arrow batch; it yields batches of `schema`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)
                pa.default_memory_pool().release_unused()

    return df.mapInArrow(giving_back(run), schema)


def key_text(column) -> F.Column:
    """crc32 of an id as text, for deterministic folds; a null id counts as 0."""
    return F.coalesce(F.crc32(column.cast("string")), F.lit(0))
