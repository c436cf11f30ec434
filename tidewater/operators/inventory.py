"""Counting and listing partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.partitions import GRAINS


def row_count(df: DataFrame) -> int:
    return df.count()


def distinct_partitions(df: DataFrame, cols: Sequence[str] = GRAINS["day"]) -> DataFrame:
    return df.select(*cols).distinct()


def collect_partitions(df: DataFrame, cols: Sequence[str] = GRAINS["day"]) -> list[tuple]:
    """Distinct partition tuples on the driver. Bounded by the number of partitions of the
    table (calendar days), not by rows: the distinct runs on the executors first."""
    return [tuple(r) for r in distinct_partitions(df, cols).collect()]


def partition_inventory(df: DataFrame, cols: Sequence[str] = GRAINS["day"]) -> DataFrame:
    """Rows per partition (partial aggregation map-side, one small shuffle)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def preview(df: DataFrame, n: int = 20, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows, returned (not printed) and only when asked for. With
    ``order_by`` the rows are the top ``n`` by those columns (a top-k: each task keeps its
    own ``n`` best rows, so only ``n`` rows per task are shuffled); without it, any ``n``."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
