"""Copy-on-write merge building blocks: which partitions a change set touches, which lake
rows survive it, the new image of the touched partitions, and which change rows are older
than the lake's version (newest wins)."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger("tidewater")


def _keys_of(changes: DataFrame, keys: Sequence[str], broadcast_keys: bool) -> DataFrame:
    """The key side of a semi/anti join. Broadcast as is when the caller bounded its size;
    otherwise de-duplicated first, so a key repeated in a third of the change rows is
    collapsed map-side and the join's build side stays one row per key."""
    k = changes.select(*keys)
    return F.broadcast(k) if broadcast_keys else k.distinct()


def touched_partitions(lake: DataFrame, changes: DataFrame, keys: Sequence[str],
                       partition_cols: Sequence[str], broadcast_keys: bool = False) -> DataFrame:
    """Distinct partitions of ``lake`` that hold a key present in ``changes``.

    A left-semi join (no fan-out on duplicate keys) on the key columns only, followed by a
    distinct on the partition columns, so the scan reads keys and directory values only.
    ``broadcast_keys`` must only be set by a caller that has bounded the key set's size.
    """
    keys, partition_cols = list(keys), list(partition_cols)
    return (lake.select(*keys, *partition_cols)
            .join(_keys_of(changes, keys, broadcast_keys), keys, "left_semi")
            .select(*partition_cols).distinct())


def unchanged_rows(existing: DataFrame, changes: DataFrame, keys: Sequence[str],
                   broadcast_keys: bool = False) -> DataFrame:
    """Rows of ``existing`` whose key is not in ``changes`` (rows with a NULL key survive)."""
    keys = list(keys)
    return existing.join(_keys_of(changes, keys, broadcast_keys), keys, "left_anti")


_WIDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def _fits(have: T.DataType, want: T.DataType) -> bool:
    """Whether every value of ``have`` is kept by a cast to ``want``."""
    if have.simpleString() == want.simpleString() or isinstance(have, T.NullType):
        return True
    kinds = (type(have), type(want))
    if all(k in _WIDER for k in kinds):
        return _WIDER.index(kinds[0]) <= _WIDER.index(kinds[1])
    if isinstance(have, T.DecimalType) and isinstance(want, T.DecimalType):
        return have.scale <= want.scale and have.precision - have.scale <= want.precision - want.scale
    if kinds[0] in _WIDER and isinstance(want, T.DecimalType):
        return want.precision - want.scale >= (3, 5, 10, 19)[_WIDER.index(kinds[0])]
    exact_double = isinstance(have, T.FloatType) or kinds[0] in _WIDER[:3]
    if isinstance(want, T.DoubleType) and exact_double:
        return True
    if isinstance(have, (T.StructType, T.ArrayType, T.MapType)):
        return kinds[0] is kinds[1] and have.simpleString() == want.simpleString()
    return kinds in ((T.VarcharType, T.StringType), (T.CharType, T.StringType), (T.TimestampNTZType, T.TimestampType),
                     (T.TimestampType, T.TimestampNTZType), (T.DateType, T.TimestampType), (T.DateType, T.TimestampNTZType))


def align_columns(df: DataFrame, target: T.StructType | Sequence[str], fill_missing: bool = False) -> DataFrame:
    """Restrict/reorder ``df`` to the target columns; with a schema, cast to the target types.

    A schema is a contract: a target column that ``df`` lacks is an error (``fill_missing``
    asks for typed NULLs instead), and so is a type whose values the cast might lose. Columns
    that the target does not have are left out with a warning.
    """
    if isinstance(target, T.StructType):
        have = set(df.columns)
        missing = [f.name for f in target.fields if f.name not in have]
        if missing and not fill_missing:
            raise ValueError(f"columns {missing} of the lake are not in the rows to write (columns: {df.columns})")
        unfit = [f"{f.name}: {df.schema[f.name].dataType.simpleString()} to {f.dataType.simpleString()}"
                 for f in target.fields if f.name in have and not _fits(df.schema[f.name].dataType, f.dataType)]
        if unfit:
            raise ValueError(f"column types do not fit the lake's: {unfit}")
        extra = [c for c in df.columns if c not in target.fieldNames()]
        if extra:
            log.warning("columns %s are not in the lake and are left out; refresh the table to add them", extra)
        return df.select(*[
            (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in target.fields])
    return df.select(*list(target))


def merge_image(existing: DataFrame, changes: DataFrame, keys: Sequence[str],
                broadcast_keys: bool = False) -> DataFrame:
    """New content of the touched partitions: surviving rows ∪ all change rows.

    Changed keys take the new row, keys unknown to the lake are inserted, bag semantics
    (a change set with duplicate keys keeps them all; see ``latest_per_key``).
    """
    kept = unchanged_rows(existing, changes, keys, broadcast_keys)
    return kept.unionByName(align_columns(changes, existing.schema))


_LAKE_STAMP = "__tw_lake_stamp"


def drop_stale_changes(changes: DataFrame, existing: DataFrame, keys: Sequence[str], stamp: str,
                       broadcast_changes: bool = False) -> DataFrame:
    """Change rows minus those older (by ``stamp``) than the row the lake already holds for
    their key. Equal or NULL stamps keep the change row, so re-applying a change set is
    harmless and only a strictly newer lake row wins. Reads keys and stamps only; the
    change side is broadcast when the caller bounded its size."""
    keys = list(keys)
    side = changes.select(*keys, stamp)
    side = F.broadcast(side) if broadcast_changes else side
    lake = existing.select(*keys, F.col(stamp).alias(_LAKE_STAMP))
    # stale versions are (key, stamp) pairs: another, newer version of the same key in the
    # change set is kept
    stale = (lake.join(side, keys, "inner")
             .where(F.col(_LAKE_STAMP) > F.col(stamp)).select(*keys, stamp).distinct())
    # the stale pairs are a subset of the change keys, so the same size bound covers them
    return changes.join(F.broadcast(stale) if broadcast_changes else stale, keys + [stamp], "left_anti")


def may_hold_stale_changes(changes: DataFrame, existing: DataFrame, stamp: str,
                           oldest_change=None) -> bool:
    """False when no change row can be older than a lake row: the oldest change stamp is not
    older than the newest stamp among the affected lake rows (the usual daily flow). One
    small aggregate per side, reading the stamp column only (the change side is skipped when
    ``oldest_change`` is already known)."""
    oldest = oldest_change if oldest_change is not None else changes.agg(F.min(stamp)).first()[0]
    newest = existing.agg(F.max(stamp)).first()[0]
    return oldest is not None and newest is not None and newest > oldest
