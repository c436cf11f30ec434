"""Partition columns of the lake and the ways to name a partition.

A lake table is Hive-style ``<root>/year=Y/month=M/day=D/part-*.parquet``; the data files
also carry ``partition_date`` (a DATE) so a reader of a single directory still sees it.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTITION_DATE = "partition_date"
# Directory name Hive/Spark use for a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

GRAINS: dict[str, tuple[str, ...]] = {
    "day": ("year", "month", "day"),
    "month": ("year", "month"),
    "year": ("year",),
}

_EXTRACT = {"year": F.year, "month": F.month, "day": F.dayofmonth}


def partition_columns(grain: str = "day") -> tuple[str, ...]:
    try:
        return GRAINS[grain]
    except KeyError:
        raise ValueError(f"unknown partition grain {grain!r}; use one of {sorted(GRAINS)}") from None


def derive_partition_columns(df: DataFrame, time_column: str, grain: str = "day") -> DataFrame:
    """Add ``partition_date = try_cast(time_column AS DATE)`` and its year/month/day ints.

    An unparseable or NULL time gives NULL for all of them (the NULL partition). A column of
    ``df`` that already has one of the names is an error: it would be overwritten.
    """
    taken = [c for c in (PARTITION_DATE, *partition_columns(grain)) if c in df.columns]
    if taken:
        raise ValueError(f"columns {taken} of the table have names of partition columns; rename them in the source")
    pdate = F.col(time_column).try_cast("date")
    cols = {PARTITION_DATE: pdate}
    for name in partition_columns(grain):
        cols[name] = _EXTRACT[name](pdate)
    return df.withColumns(cols)


def partition_key_strings(df: DataFrame, cols: Sequence[str] = GRAINS["day"]) -> DataFrame:
    """Partition columns cast to string under the same names."""
    return df.select([F.col(c).cast("string").alias(c) for c in cols])


def partition_path(cols: Sequence[str] = GRAINS["day"], base: str = "") -> Column:
    """``base/year=Y/month=M/day=D`` as a column; a NULL part gives a NULL path."""
    parts: list[Column] = [F.lit(base)] if base else []
    for c in cols:
        parts += [F.lit(f"/{c}="), F.col(c).cast("string")]
    return F.concat(*parts)


def partition_dir(root: str, values: Sequence, cols: Sequence[str] = GRAINS["day"]) -> str:
    """Directory of one partition; NULL values map to the Hive default partition name."""
    segs = [f"{c}={NULL_PARTITION if v is None else int(v)}" for c, v in zip(cols, values)]
    return "/".join([root.rstrip("/")] + segs)


def partition_predicate_frame(df: DataFrame, cols: Sequence[str] = GRAINS["day"]) -> DataFrame:
    """One ``cond`` row per distinct partition of ``df``, computed on the executors."""
    terms = []
    for c in cols:
        terms.append(F.when(F.col(c).isNull(), F.lit(f"{c} IS NULL"))
                     .otherwise(F.concat(F.lit(f"{c} = '"), F.col(c).cast("string"), F.lit("'"))))
    cond = F.concat(F.lit("("), F.concat_ws(" AND ", *terms), F.lit(")"))
    return df.select(*cols).distinct().select(cond.alias("cond"))


def partition_filter(partitions: Iterable[Sequence], cols: Sequence[str] = GRAINS["day"]) -> Column:
    """Null-safe Column predicate selecting exactly the listed partitions.

    It references partition columns only, so Spark evaluates it against the directory
    listing (partition pruning) and never opens files of other partitions.
    """
    plain, with_null = [], []
    for p in partitions:
        (with_null if any(v is None for v in p) else plain).append(tuple(p))
    ors: list[Column] = []
    if plain:
        key = F.struct(*[F.col(c) for c in cols])
        lits = [F.struct(*[F.lit(v).cast("int").alias(c) for c, v in zip(cols, p)]) for p in plain]
        ors.append(key.isin(*lits))
    for p in with_null:
        term = None
        for c, v in zip(cols, p):
            t = F.col(c).isNull() if v is None else (F.col(c) == F.lit(v))
            term = t if term is None else (term & t)
        ors.append(term)
    if not ors:
        return F.lit(False)
    out = ors[0]
    for o in ors[1:]:
        out = out | o
    return out


def dates_to_partitions(dates: Iterable[_dt.date], grain: str = "day") -> list[tuple]:
    """Distinct partition tuples covering calendar dates, at the given grain."""
    cols = partition_columns(grain)
    seen: dict[tuple, None] = {}
    for d in dates:
        full = {"year": d.year, "month": d.month, "day": d.day}
        seen[tuple(full[c] for c in cols)] = None
    return list(seen)
