"""A space-filling curve over columns, to cluster rows inside a partition.

Sorted by one column, a file's row groups are narrow in that column only. Along a Z-order curve they
are narrow in several, so a lookup by any of them skips most row groups by their minimum and maximum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BITS = 6  # 64 ranges of equal weight for each column


def _number(df: DataFrame, name: str) -> Column:
    """The column as a number in its order; of a text or binary, its first seven bytes."""
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, T.BooleanType):
        return c.cast("int").cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("double")
    raise ValueError(f"column {name!r} of type {kind.simpleString()} has no place on a curve")


def z_order(df: DataFrame, columns: Sequence[str]) -> Column:
    """The place of a row on the curve. Each column is cut into ranges of equal weight by its
    quantiles (one aggregate over ``df``, whose result does not grow with it); the curve takes the
    bits of the ranges' numbers in turn. NULLs come first."""
    if not 1 <= len(columns) <= 10:
        raise ValueError("a curve takes one to ten columns")
    numbers = [_number(df, c) for c in columns]
    shares = [i / 2**_BITS for i in range(1, 2**_BITS)]
    splits = df.agg(*[F.percentile_approx(n, shares, 10_000).alias(f"s{i}") for i, n in enumerate(numbers)]).first()
    out = F.lit(0).cast("long")
    for i, n in enumerate(numbers):
        place = F.lit(0)
        for split in sorted(set(splits[f"s{i}"] or [])):
            place = place + (n > F.lit(split)).cast("int")
        place = F.coalesce(place, F.lit(0)).cast("long")
        for b in range(_BITS):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(place, b).bitwiseAND(F.lit(1)), b * len(columns) + i))
    return out
