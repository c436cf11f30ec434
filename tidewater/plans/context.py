"""The bundle a job runs with: session, source, lake root and table specs."""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tidewater.operators.sizing import DEFAULT_BROADCAST_LIMIT
from tidewater.plans.specs import TableSpec
from tidewater.sources.catalog import Source


@dataclass
class EngineContext:
    spark: SparkSession
    source: Source
    lake_root: str
    tables: Mapping[str, TableSpec] = field(default_factory=dict)
    broadcast_limit: int = DEFAULT_BROADCAST_LIMIT
    max_records_per_file: int | None = None
    # None = automatic: no shuffle for a full copy of an unpartitioned table (each input
    # split becomes one file), REBALANCE for everything else; or a value of sinks.lake.LAYOUTS.
    write_layout: str | None = None
    # one writer per table (see plans.locking); a lock without a heartbeat for ``lock_ttl_s``
    # is a dead driver's
    locking: bool = True
    lock_ttl_s: float = 1800
    # lakes smaller than this (bytes outside the partitions that an update rewrites anyway) are
    # searched for changed keys directly; larger ones through the files' key filters
    key_filter_min_bytes: int = 256 * 1024 * 1024
    _held: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.lake_root = self.lake_root.rstrip("/")

    def table_path(self, name: str) -> str:
        return f"{self.lake_root}/{name.strip('/')}"

    def write_options(self, name: str | None = None, full_copy_unpartitioned: bool = False) -> dict:
        layout = self.write_layout or ("as_is" if full_copy_unpartitioned else "rebalance")
        cluster_by = self.spec(name).cluster_by if name else ()
        return {"max_records_per_file": self.max_records_per_file, "layout": layout, "cluster_by": cluster_by}

    @contextmanager
    def lock(self, name: str, job: str):
        """The table's writer lock; while it is held ``check_lock`` tells whether it still is."""
        from tidewater.plans.locking import table_lock

        if not self.locking:
            yield None
            return
        with table_lock(self.spark, self.lake_root, name, job, self.lock_ttl_s) as beat:
            self._held[name] = beat
            try:
                yield beat
            finally:
                self._held.pop(name, None)

    def check_lock(self, name: str) -> None:
        """Called right before anything of the table is overwritten, moved or deleted: a job whose
        lock was taken over stops there."""
        if name in self._held:
            self._held[name].check()

    def spec(self, name: str) -> TableSpec:
        return self.tables.get(name) or TableSpec(name)
