"""Size bounds that decide whether a key set may be broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Per-row overhead of a broadcast hash relation entry (row header, hash slot), bytes.
ROW_OVERHEAD = 24
# Largest key set the jobs broadcast explicitly, bytes. Anything bigger is left to the
# planner (sort-merge / shuffled hash join, with AQE's own runtime size checks).
DEFAULT_BROADCAST_LIMIT = 64 * 1024 * 1024

_FIXED = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4,
          T.DoubleType: 8, T.BooleanType: 1, T.DateType: 4, T.TimestampType: 8,
          T.TimestampNTZType: 8, T.DecimalType: 16}


def change_profile(df: DataFrame, keys: Sequence[str], partition_cols: Sequence[str] = (),
                   oldest_of: str | None = None) -> tuple:
    """Row count, an upper bound of the bytes the key columns take, the distinct partition
    tuples and (with ``oldest_of``) the smallest value of that column, all from ONE
    aggregate over ``df``. Returns ``(n, bound, partitions)``, plus ``oldest`` when asked.

    Fixed-width key types use their width; strings/binaries use the longest value seen.
    The partition set is bounded by the number of partitions (calendar days), not by rows.
    """
    aggs = [F.count(F.lit(1)).alias("n")]
    width = 0
    widths = []
    for k in keys:
        dt = df.schema[k].dataType
        fixed = next((w for t, w in _FIXED.items() if isinstance(dt, t)), None)
        if fixed is None:
            widths.append(f"w_{len(widths)}")
            aggs.append(F.max(F.octet_length(F.col(k).cast("string"))).alias(widths[-1]))
        else:
            width += fixed
    if partition_cols:
        aggs.append(F.collect_set(F.struct(*partition_cols)).alias("parts"))
    if oldest_of:
        aggs.append(F.min(oldest_of).alias("oldest"))
    row = df.agg(*aggs).first()
    n = int(row["n"])
    width += sum(int(row[w] or 0) for w in widths)
    parts = [tuple(p) for p in row["parts"]] if partition_cols else []
    if oldest_of:
        return n, n * (width + ROW_OVERHEAD), parts, row["oldest"]
    return n, n * (width + ROW_OVERHEAD), parts


def count_and_key_bytes(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Row count and an upper bound of the bytes the key columns take, in one scan."""
    n, bound, _ = change_profile(df, keys)
    return n, bound


def may_broadcast(bound_bytes: int, limit: int = DEFAULT_BROADCAST_LIMIT) -> bool:
    return bound_bytes <= limit
