"""Reading one or many named tables from a source, and listing its tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Source(Protocol):
    def table(self, name: str) -> DataFrame: ...
    def list_tables(self) -> list[str]: ...


def scan_one_or_many(source: Source, table_name: str | None = None,
                     table_list: Sequence[str] | None = None) -> DataFrame | dict[str, DataFrame]:
    """One frame for ``table_name``, or ``{name: frame}`` in list order for ``table_list``."""
    if table_name is None and table_list is None:
        raise ValueError("give table_name or table_list")
    if table_list is not None:
        return {name: source.table(name) for name in table_list}
    return source.table(table_name)


def list_source_tables(source: Source) -> list[str]:
    return list(source.list_tables())


def table_counts(source: Source, names: Sequence[str]) -> DataFrame:
    """``(table_name, n)`` for each table: one aggregate per table, unioned into one job."""
    frames = [source.table(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n")
              for n in names]
    if not frames:
        from pyspark.sql import SparkSession

        return SparkSession.active().createDataFrame([], "table_name string, n bigint")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
