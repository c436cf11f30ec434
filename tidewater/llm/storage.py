"""Files that tasks write to the cluster's shared folder.

Each task writes under a name of its own attempt and renames the finished file, so a lost or
repeated attempt leaves no half file under a final name. Paths are given as URIs; pyarrow
resolves the file system (local or mounted folders, HDFS, object stores).
"""

from __future__ import annotations

import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below ``spark.checkpoint.dir``, as a URI."""
    path = scratch_path(spark, "llm", label)
    if "://" in path:
        return path
    return "file://" + os.path.abspath(path.removeprefix("file:"))


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to a fresh shared folder and read from there: cuts the lineage, and
    tells later plans the table's real size."""
    folder = shared_folder(df.sparkSession, label)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def finished_file(folder: str, name: str):
    """A binary stream for ``folder``/``name``, which appears there when it is complete."""
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    attempt = TaskContext.get().taskAttemptId() if TaskContext.get() else 0
    # A leading underscore hides the file from readers of the folder until it is renamed.
    part = f"{root}/_{name}.{attempt}"
    with system.open_output_stream(part) as out:
        yield out
    system.move(part, f"{root}/{name}")


def release_memory() -> None:
    """Gives memory that a finished task has freed back to the system. Python workers live on for
    later tasks, and idle ones would keep it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int = 500):
    """``run`` over slices of at most ``rows`` rows, so that only so many texts are Python objects at
    once; what its task has freed is given back at the end."""

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                yield batch.slice(i, rows)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(sliced(batches))
        finally:
            release_memory()

    return whole
