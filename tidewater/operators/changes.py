"""Change-set extraction: window filter, emptiness test, newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.windows import change_window_condition

_ROW, _ALONE = "__tw_row", "__tw_alone"


def change_window(df: DataFrame, time_column: str, as_of=None, days: int = 1) -> DataFrame:
    """Rows of ``df`` created/changed strictly inside ``as_of ± days``.

    A plain DataFrame filter: Spark pushes it to the Parquet scan or into the JDBC
    ``WHERE`` clause, so only the window is read from the source.
    """
    return df.where(change_window_condition(time_column, as_of, days))


def has_changes(df: DataFrame) -> bool:
    """True when ``df`` has at least one row (reads at most one row, not a full count)."""
    return not df.isEmpty()


def has_changes_frame(df: DataFrame) -> DataFrame:
    """One row ``has_changes`` boolean, lazily; each task reads its part until its first row."""
    return df.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_changes"))


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


def any_null(keys: Sequence[str]):
    """Condition: at least one key column is NULL."""
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def latest_per_key(df: DataFrame, keys: Sequence[str], order_column: str | None) -> DataFrame:
    """Keep one row per key: the one with the greatest ``order_column`` (NULL is the least;
    without an order column, any one). Rows with a NULL key column are all kept: they are no
    versions of each other.

    An aggregate of ``max(struct(order_column, other columns))``, combined map-side before the
    shuffle: a key holding a third of all rows is reduced to one row per task, never gathered
    into one task. Ties on ``order_column`` are broken by the other columns that have an order;
    rows that still tie differ in columns without one (maps) at most, and any of them is kept.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    ordered = [c for c in others if _orderable(df.schema[c].dataType) and c != order_column]
    if order_column:
        ordered.insert(0, order_column)
    marked = df.withColumn(_ALONE, F.when(any_null(keys), F.monotonically_increasing_id()))
    row = F.struct(*others) if others else F.struct(F.lit(1).alias(_ROW))
    if len(ordered) == len(others):
        picked = F.max(F.struct(*ordered)) if ordered else F.first(row)
    else:
        # a struct is never NULL, so rows whose stamps are all NULL keep their columns
        picked = F.max_by(row, F.struct(*ordered)) if ordered else F.first(row)
    picked = marked.groupBy(*keys, _ALONE).agg(picked.alias(_ROW))
    return picked.select(*[F.col(c) if c in keys else F.col(f"{_ROW}.{c}").alias(c) for c in df.columns])
