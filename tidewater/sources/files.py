"""File and in-memory sources: ``table(name) -> DataFrame`` and ``list_tables()``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tidewater import fs


class ParquetSource:
    """Source tables kept as Parquet: ``<root>/<name>.parquet`` (file or folder) or
    ``<root>/<name>/``. Filters and projections applied later reach the Parquet scan."""

    def __init__(self, spark: SparkSession, root: str, suffix: str = ".parquet"):
        self.spark, self.root, self.suffix = spark, root.rstrip("/"), suffix

    def path(self, name: str) -> str:
        with_suffix = f"{self.root}/{name}{self.suffix}"
        if self.suffix and fs.exists(self.spark, with_suffix):
            return with_suffix
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def list_tables(self) -> list[str]:
        """Names of ``<name><suffix>`` entries and of plain sub-folders; hidden entries and
        other files are not tables."""
        names = set()
        for child, is_dir in fs.list_entries(self.spark, self.root):
            if child.startswith(("_", ".")):
                continue
            if self.suffix and child.endswith(self.suffix):
                names.add(child[: -len(self.suffix)])
            elif is_dir:
                names.add(child)
        return sorted(names)


class FrameSource:
    """Source over DataFrames (or zero-argument factories) already defined by the caller,
    e.g. a view derived from other tables. Frames stay lazy until a job reads them."""

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self._frames = dict(frames)

    def table(self, name: str) -> DataFrame:
        try:
            f = self._frames[name]
        except KeyError:
            raise KeyError(f"source has no table {name!r}") from None
        return f if isinstance(f, DataFrame) else f()

    def list_tables(self) -> list[str]:
        return sorted(self._frames)
