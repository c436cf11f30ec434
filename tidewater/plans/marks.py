"""Inserts from a high-water mark.

Instead of a window around a date, a run takes every row created since the last one: the largest
created stamp so far is kept, and with it digests of the rows at its edge, the last ``lateness`` before
it. The next run starts there; rows whose digest is kept are recognised and left out, so runs may be
irregular, repeated, or find rows that came late, and the lake holds each row once.

A run writes the next state's digests first, adds the same staged rows as a batch of that state's
number (``sinks.batches``), and then names the state. Whatever it dies in, the next run finds either
a batch without a named state, and names it, or neither, and starts again.
"""

from __future__ import annotations

import datetime as dt
import json
import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater import fs
from tidewater.operators.filefacts import row_hash
from tidewater.operators.staging import materialise
from tidewater.plans.context import EngineContext
from tidewater.sinks.batches import batch_files

MARKS_FOLDER = "_tidewater_marks"
DEFAULT_LATENESS = dt.timedelta(days=2)
EDGE = "stamp timestamp_ntz, first long, second long"

log = logging.getLogger("tidewater")


def _folder(ctx: EngineContext, name: str) -> str:
    return f"{ctx.lake_root}/{MARKS_FOLDER}/{name.strip('/')}"


def read_mark(ctx: EngineContext, name: str) -> tuple[int, dt.datetime | None]:
    """Number and high-water mark of the table's newest named state; (0, None) before the first."""
    named = [int(c.removesuffix(".json")) for c, is_dir in fs.list_entries(ctx.spark, _folder(ctx, name)) if not is_dir and c.endswith(".json") and c[:-5].isdigit()]
    if not named:
        return 0, None
    text = json.loads(fs.read_text(ctx.spark, f"{_folder(ctx, name)}/{max(named)}.json"))["mark"]
    return max(named), dt.datetime.fromisoformat(text)


def _digest(df: DataFrame, keys) -> list[Column]:
    """Two hashes of the row's key, or of the whole row where the table has none."""
    fields = T.StructType([df.schema[k] for k in keys]) if keys else df.schema
    return [F.xxhash64(row_hash(fields), *[F.col(f"`{f.name}`").cast("string") for f in fields.fields if not isinstance(f.dataType, T.MapType)], F.lit(salt)).alias(n)
            for n, salt in (("first", 1), ("second", 2))]


def _name_state(ctx: EngineContext, name: str, number: int) -> None:
    """Names a prepared state whose batch is in the table, and removes those before it."""
    spark, folder = ctx.spark, _folder(ctx, name)
    mark = spark.read.schema(EDGE).parquet(f"{folder}/{number}").agg(F.max("stamp")).first()[0]
    fs.write_text_at_once(spark, f"{folder}/{number}.json", json.dumps({"mark": mark.isoformat()}))
    for child, _ in fs.list_entries(spark, folder):
        if child.split(".")[0].isdigit() and int(child.split(".")[0]) < number:
            fs.delete(spark, f"{folder}/{child}")


def insert_new_rows(ctx: EngineContext, name: str, lateness: dt.timedelta = DEFAULT_LATENESS):
    """Append every source row created after the high-water mark, or up to ``lateness`` before it
    and not seen yet. The first run takes all rows. Rows without a created stamp are never taken,
    as in windows; rows that come later than ``lateness`` are missed: ``refresh`` finds them."""
    from tidewater.plans.jobs import JobResult, _append_changes, _recover, _require_columns

    spec, spark = ctx.spec(name), ctx.spark
    if not spec.created_column:
        raise ValueError(f"table {name!r} has no created column; insert needs one")
    with ctx.lock(name, "insert"):
        _recover(ctx, name)
        number, mark = read_mark(ctx, name)
        if batch_files(spark, ctx.lake_root, name, f"mark-{number + 1}") is not None:
            number += 1  # its job died before it named the state
            _name_state(ctx, name, number)
            _, mark = read_mark(ctx, name)
        folder = _folder(ctx, name)
        source = ctx.source.table(name)
        _require_columns(source, [spec.created_column, *spec.keys], name, "created/key")
        stamp, kind = F.col(spec.created_column), source.schema[spec.created_column].dataType
        digests = _digest(source, spec.keys)
        rows = source.where(stamp.isNotNull())
        if mark is not None:
            rows = source.where(stamp >= F.lit((mark - lateness).isoformat(sep=" ")).cast(kind))
        seen = spark.read.schema(EDGE).parquet(f"{folder}/{number}") if number else spark.createDataFrame([], EDGE)
        marked = rows.withColumns({"__tw_first": digests[0], "__tw_second": digests[1]})
        edge = seen.select(F.col("first").alias("__tw_first"), F.col("second").alias("__tw_second"))
        staged = materialise(marked.join(edge, ["__tw_first", "__tw_second"], "left_anti").select(*source.columns, "__tw_first", "__tw_second"), label=f"{name}-new")
        try:
            fresh = staged.df
            top = fresh.agg(F.max(stamp.cast("timestamp_ntz"))).first()[0]
            if top is None:
                return JobResult(name, "insert", "no_changes", 0)
            top = max(top, mark) if mark is not None else top
            held = seen.unionByName(fresh.select(stamp.cast("timestamp_ntz").alias("stamp"), F.col("__tw_first").alias("first"), F.col("__tw_second").alias("second")))
            limit = F.lit((top - lateness).isoformat(sep=" ")).cast("timestamp_ntz")
            # the rows at the mark stay, so that the state holds the mark itself
            held.where(F.col("stamp") >= limit).write.mode("overwrite").parquet(f"{folder}/{number + 1}")
            n = fresh.count()
            _append_changes(ctx, name, fresh.drop("__tw_first", "__tw_second"), batch=f"mark-{number + 1}")
            ctx.check_lock(name)
            _name_state(ctx, name, number + 1)
        finally:
            staged.release()
    log.info("insert %s: %d new rows up to %s", name, n, top)
    return JobResult(name, "insert", "written", n)
