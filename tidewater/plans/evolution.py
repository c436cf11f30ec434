"""Tables whose columns change: a schema log per table.

A table with ``evolve`` in its spec takes new source columns and wider types. The schema that a write
needs is put into the log (``_tidewater_schemas/<table>/<n>.json``) before the write; reads use the
newest one, under which old files have NULL in added columns and their values in widened ones.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidewater import fs
from tidewater.plans.context import EngineContext
from tidewater.sources.lake import lake_scan

SCHEMAS_FOLDER = "_tidewater_schemas"
_INTS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]


def _folder(ctx: EngineContext, name: str) -> str:
    return f"{ctx.lake_root}/{SCHEMAS_FOLDER}/{name.strip('/')}"


def logged_schema(ctx: EngineContext, name: str) -> T.StructType | None:
    """The newest schema in the table's log; None if it has none."""
    numbers = [int(c[:-5]) for c, is_dir in fs.list_entries(ctx.spark, _folder(ctx, name)) if not is_dir and c.endswith(".json") and c[:-5].isdigit()]
    return T.StructType.fromJson(json.loads(fs.read_text(ctx.spark, f"{_folder(ctx, name)}/{max(numbers)}.json"))) if numbers else None


def log_schema(ctx: EngineContext, name: str, schema: T.StructType) -> None:
    """Adds the schema to the log unless it is the newest there already."""
    if logged_schema(ctx, name) == schema:
        return
    numbers = [int(c[:-5]) for c, _ in fs.list_entries(ctx.spark, _folder(ctx, name)) if c.endswith(".json") and c[:-5].isdigit()]
    fs.write_text_at_once(ctx.spark, f"{_folder(ctx, name)}/{max(numbers, default=0) + 1}.json", json.dumps(schema.jsonValue()))


def _wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds both, if files of either can be read as it."""
    if a == b:
        return a
    if type(a) in _INTS and type(b) in _INTS:
        return max(a, b, key=lambda t: _INTS.index(type(t)))
    if {type(a), type(b)} == {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType) and a.scale == b.scale:
        return max(a, b, key=lambda t: t.precision)
    if isinstance(b, T.NullType):
        return a
    return None


def evolved(lake: T.StructType, rows: T.StructType, partition_cols) -> T.StructType:
    """The lake's schema with the rows' new columns before the partition columns and with types wide
    enough for both. A column that the rows lack is an error, as is a type that fits neither way."""
    missing = [f.name for f in lake.fields if f.name not in rows.fieldNames()]
    if missing:
        raise ValueError(f"columns {missing} of the lake are not in the rows to write (columns: {rows.fieldNames()})")
    fields, conflicts = [], []
    for f in lake.fields:
        kind = _wider(f.dataType, rows[f.name].dataType)
        if kind is None:
            conflicts.append(f"{f.name}: {rows[f.name].dataType.simpleString()} and {f.dataType.simpleString()}")
        fields.append(T.StructField(f.name, kind or f.dataType, True))
    if conflicts:
        raise ValueError(f"column types do not fit the lake's: {conflicts}")
    added = [T.StructField(f.name, f.dataType, True) for f in rows.fields if f.name not in lake.fieldNames()]
    parts = [f for f in fields if f.name in partition_cols]
    return T.StructType([f for f in fields if f.name not in partition_cols] + added + parts)


def read_table(ctx: EngineContext, name: str) -> DataFrame:
    """The lake table under its newest schema."""
    return lake_scan(ctx.spark, ctx.table_path(name), logged_schema(ctx, name))
