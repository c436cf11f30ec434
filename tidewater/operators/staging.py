"""Materialise a frame once into the shared folder and read it back.

Used for change sets read from a live source: every later action (emptiness test,
partition lookup, merge, write) then sees the same rows, the source is queried once, and
a lost executor re-reads staged Parquet instead of re-querying a source that may have
moved on. This is the lineage cut the jobs rely on (never a machine-local checkpoint).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tidewater import fs
from tidewater.session import scratch_path

ALIVE = "_tidewater_alive"  # hidden from readers
ALIVE_EVERY_S = 60


class Staged:
    """A staged copy: ``.df`` reads it back; ``release()`` deletes the folder."""

    def __init__(self, spark: SparkSession, path: str, df: DataFrame):
        from tidewater.plans.locking import Heartbeat

        self.spark, self.path, self.df = spark, path, df
        alive = f"{path}/{ALIVE}"
        fs.write_text(spark, alive, path)
        self._beat = Heartbeat(spark, alive, path, ALIVE_EVERY_S).__enter__()

    def release(self) -> None:
        self._beat.__exit__()
        fs.delete(self.spark, self.path)

    def __enter__(self) -> "Staged":
        return self

    def __exit__(self, *exc) -> None:
        self.release()


def materialise(df: DataFrame, label: str = "stage") -> Staged:
    spark = df.sparkSession
    path = scratch_path(spark, "stage", label)
    df.write.mode("overwrite").parquet(path)
    return Staged(spark, path, spark.read.schema(df.schema).parquet(path))


def cleanup_scratch(spark: SparkSession, older_than_s: int = 24 * 3600) -> list[str]:
    """Delete staged change sets left by jobs whose driver died (normally each job deletes
    its own in ``finally``). Only this library's ``tidewater-stage`` folders under the shared
    root are considered, and only those without a sign of life for ``older_than_s``: a running
    job rewrites a file in its folder all the time. Returns the deleted paths."""
    from tidewater.session import shared_root

    root = f"{shared_root(spark)}/tidewater-stage"
    clock = f"{root}/.clock-{os.urandom(4).hex()}"
    now_ms = fs.touch(spark, clock)  # the file system's clock, like the folders' stamps
    fs.delete(spark, clock)
    removed = []
    for name, is_dir in fs.list_entries(spark, root):
        if not is_dir or name.startswith("."):
            continue
        path = f"{root}/{name}"
        stamp = max((t for t in (fs.modification_time(spark, path), fs.modification_time(spark, f"{path}/{ALIVE}")) if t is not None), default=None)
        if stamp is not None and now_ms - stamp > older_than_s * 1000:
            fs.delete(spark, path)
            removed.append(path)
    return removed
