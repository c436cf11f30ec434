"""Sets of days as ranges.

A change set touches days, and days mostly come in stretches. A predicate with one term for each
range (gaps and islands) instead of one for each day keeps the plan small, can be pushed to Parquet
row groups or a JDBC source, and prunes the same partitions.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.partitions import GRAINS, PARTITION_DATE


def _next(part: tuple) -> tuple:
    """The partition that follows: the next day, month or year."""
    if len(part) == 3:
        d = dt.date(*part) + dt.timedelta(days=1)
        return (d.year, d.month, d.day)
    if len(part) == 2:
        return (part[0] + part[1] // 12, part[1] % 12 + 1)
    return (part[0] + 1,)


def partition_ranges(partitions: Iterable[Sequence]) -> list[tuple[tuple, tuple]]:
    """``(first, last)`` of each stretch of neighbouring partitions, in order. Tuples with NULL parts are
    no dates and are left out (see ``range_filter``)."""
    plain = sorted({tuple(int(v) for v in p) for p in partitions if all(v is not None for v in p)})
    out: list[list[tuple]] = []
    for p in plain:
        if out and _next(out[-1][1]) == p:
            out[-1][1] = p
        else:
            out.append([p, p])
    return [(a, b) for a, b in out]


def _number(cols: Sequence[str]) -> Column:
    """Partition columns as one integer in calendar order."""
    out = F.col(cols[0]).cast("int")
    for c in cols[1:]:
        out = out * 100 + F.col(c)
    return out


def _value(part: Sequence[int]) -> int:
    out = 0
    for v in part:
        out = out * 100 + v
    return out


def range_filter(partitions: Iterable[Sequence], cols: Sequence[str] = GRAINS["day"]) -> Column:
    """Predicate that selects exactly the listed partitions, one term for each stretch of them (and
    one for each tuple with NULLs). It needs the partition columns only, so it prunes directories."""
    partitions = [tuple(p) for p in partitions]
    number, out = _number(cols), F.lit(False)
    for first, last in partition_ranges(partitions):
        out = out | (number.between(_value(first), _value(last)) if first != last else number == _value(first))
    out = F.coalesce(out, F.lit(False))
    for p in sorted({p for p in partitions if any(v is None for v in p)}, key=str):
        term = F.lit(True)
        for c, v in zip(cols, p):
            term = term & F.col(c).eqNullSafe(F.lit(v).cast("int"))
        out = out | term
    return out


def _start(part: Sequence[int]) -> dt.date:
    return dt.date(*(tuple(part) + (1, 1))[:3])


def time_ranges(df: DataFrame, time_column: str, partitions: Iterable[Sequence], grain: str = "day") -> Column:
    """Predicate on the time column itself for rows of the listed partitions: ranges of plain
    comparisons, which a source can evaluate. For a column that is neither date nor timestamp it is
    true, as are times that give NULL partitions; use it beside the exact partition predicate."""
    kind = df.schema[time_column].dataType
    if not isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit(True)
    partitions = [tuple(p) for p in partitions]
    c, out = F.col(time_column), F.lit(False)
    for first, last in partition_ranges(partitions):
        end = _next(last)
        term = c >= F.lit(_start(first).isoformat()).cast(kind)
        if end[0] <= 9999:
            term = term & (c < F.lit(_start(end).isoformat()).cast(kind))
        out = out | term
    return out | c.isNull() if any(None in p for p in partitions) else out


def date_ranges(df: DataFrame, column: str = PARTITION_DATE) -> DataFrame:
    """(first_day, last_day, days) of each stretch of neighbouring days in a date column, and one row
    of NULLs if it has NULLs. Runs on the executors: days are made distinct map-side, so the window
    orders a calendar, not rows."""
    days = df.select(F.col(column).cast("date").alias("d")).distinct()
    # a day less its rank is the same all along a stretch
    ranked = days.withColumn("island", F.when(F.col("d").isNotNull(), F.date_sub("d", F.row_number().over(Window.orderBy("d")))))
    return ranked.groupBy("island").agg(F.min("d").alias("first_day"), F.max("d").alias("last_day"), F.count(F.lit(1)).alias("days")).drop("island")
