"""Quality checks of what changed: only touched partitions and the files that may hold their keys are read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.functions.ranges import range_filter
from tidewater.operators.filefacts import files_below, files_that_may_hold, key_filters
from tidewater.operators.quality import _any, dq_missing_references, dq_unique
from tidewater.operators.sizing import count_and_key_bytes, may_broadcast
from tidewater.operators.staging import materialise
from tidewater.plans.context import EngineContext
from tidewater.plans.jobs import lake_schema
from tidewater.sources.lake import lake_scan


def dq_unique_changed(ctx: EngineContext, name: str, columns: Sequence[str], partitions: Sequence[tuple],
                      previous: DataFrame | None = None) -> DataFrame:
    """Values of a UNIQUE column set that repeat, with their count ``n``: what ``dq_unique`` finds in the
    whole table, if ``previous`` is its result (or this one's) before ``partitions`` changed.

    A value can only have become a repeat, or have ceased to be one, if a row of it stands in a touched
    partition or if it was one before. Those values are looked up in the other files through the
    files' key filters (kept by file, so a change set builds its own files' only), and counted exactly
    in the files that may hold them. More values than may be broadcast are checked in the whole table.
    """
    spark, columns = ctx.spark, list(columns)
    path, cols = ctx.table_path(name), list(ctx.spec(name).partition_cols)
    schema = lake_schema(spark, path, cols)
    lake = lake_scan(spark, path, schema)
    given = ~_any(F.col(c).isNull() for c in columns)
    values = lake.where(range_filter(partitions, cols)).where(given).select(*columns)
    if previous is not None:
        values = values.unionByName(previous.select(*[F.col(c).cast(schema[c].dataType) for c in columns]))
    staged = materialise(values.distinct(), label=f"{name}-values")
    n, bound = count_and_key_bytes(staged.df, columns)
    if not may_broadcast(bound, ctx.broadcast_limit):
        staged.release()
        return dq_unique(lake, columns)
    # the staged values are read by the result; cleanup_scratch removes them later
    return dq_unique(_rows_holding(ctx, name, schema, columns, staged.df if n else None), columns)


def _rows_holding(ctx: EngineContext, name: str, schema: T.StructType, columns: list[str], values: DataFrame | None) -> DataFrame:
    """``columns`` of the lake rows that hold one of ``values`` (same names and types, few enough to
    broadcast), from the files whose key filters let one pass."""
    spark, path = ctx.spark, ctx.table_path(name)
    files = files_below(spark, path) if values is not None else []
    hit = files_that_may_hold(key_filters(spark, ctx.lake_root, name, path, files, schema, columns), values, columns) if files else []
    if not hit:
        return spark.createDataFrame([], T.StructType([schema[c] for c in columns]))
    held = spark.read.option("basePath", path.rstrip("/")).schema(schema).parquet(*[f"{path}/{f}" for f in hit])
    return held.select(*columns).join(F.broadcast(values), columns, "left_semi")


def dq_foreign_key_changed(ctx: EngineContext, child: str, parent: str, child_keys: Sequence[str], parent_keys: Sequence[str] | None = None,
                           partitions: Sequence[tuple] = (), removed: DataFrame | None = None, previous: DataFrame | None = None) -> DataFrame:
    """References of ``child`` without a row in ``parent``, with the number of child rows ``n_refs``: what
    ``dq_missing_references`` finds in the whole tables, if ``previous`` is its result (or this one's) before
    the child's ``partitions`` changed and the parent lost at most the keys in ``removed`` (a frame with the
    parent's key columns; keys that are still there do no harm). Parents may have got any new rows.

    Only a reference of a touched partition, one that was missing before, or one to a removed key can have
    changed its state. Those are sought in the parent's files, then what is missing in the child's, both
    through the files' key filters. More of them than may be broadcast are checked in the whole tables, and
    so is a child without partitions. References with a NULL are exempt, as in SQL.
    """
    spark, child_keys = ctx.spark, list(child_keys)
    parent_keys = list(parent_keys or child_keys)
    cols, parent_cols = list(ctx.spec(child).partition_cols), list(ctx.spec(parent).partition_cols)
    schema, parent_schema = (lake_schema(spark, ctx.table_path(t), c) for t, c in ((child, cols), (parent, parent_cols)))
    rows, parents = lake_scan(spark, ctx.table_path(child), schema), lake_scan(spark, ctx.table_path(parent), parent_schema)
    if not cols:
        return dq_missing_references(rows, parents, child_keys, parent_keys)
    as_child = lambda names: [F.col(c).try_cast(schema[k].dataType).alias(k) for c, k in zip(names, child_keys)]
    values = rows.where(range_filter(partitions, cols)).select(*child_keys)
    if previous is not None:
        values = values.unionByName(previous.select(*as_child(child_keys)))
    if removed is not None:
        values = values.unionByName(removed.select(*as_child(parent_keys)))
    staged = materialise(values.where(~_any(F.col(c).isNull() for c in child_keys)).distinct(), label=f"{child}-references")
    n, bound = count_and_key_bytes(staged.df, child_keys)
    if not may_broadcast(bound, ctx.broadcast_limit):
        staged.release()
        return dq_missing_references(rows, parents, child_keys, parent_keys)
    # Filters hash the parent's own types: a reference that these can't hold has no parent.
    as_parent = [F.col(c).try_cast(parent_schema[k].dataType).alias(k) for c, k in zip(child_keys, parent_keys)]
    sought = staged.df.select(*as_parent).where(~_any(F.col(k).isNull() for k in parent_keys))
    found = _rows_holding(ctx, parent, parent_schema, parent_keys, sought if n else None)
    missing = materialise(dq_missing_references(staged.df, found, child_keys, parent_keys).drop("n_refs"), label=f"{child}-missing")
    staged.release()
    held = _rows_holding(ctx, child, schema, child_keys, missing.df if n else None)
    return held.groupBy(*child_keys).agg(F.count(F.lit(1)).alias("n_refs"))
