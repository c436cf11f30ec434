"""


Every query reads the given tables (or frames Spark derives from them) in full. Queries
that exercise lake writes use a fresh lake folder below the session's shared
``spark.checkpoint.dir`` and return a lazy read of the resulting lake.

Scenario used by the change-data-capture queries (all derived from ``events``):

* the lake was loaded on 2024-01-25 00:00 with every event created before then
  (``last_updated_at = ts``);
* afterwards the source changed: every purchase got ``value + 1000`` and was stamped
  ``ts + 10 days``; every event created on 2024-01-10 was re-stamped
  ``2024-01-25 06:00`` (a backfill); events created from 2024-01-25 on are new keys;
* ``update`` runs with ``as_of = 2024-01-25`` and the reference's one-day window, so
  it picks up purchases created 2024-01-14/15, the backfilled day and new events of
  2024-01-24/25, and must leave every other row as loaded.

A second table, ``orders`` at month grain: pending orders were re-priced (doubled) and
stamped 30 days after they were placed; a 15-day window around 1998-01-15 is applied.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import json
import os
import shutil
import sys
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The package sits next to this file; make it importable however this file is loaded.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from tidewater import fs
from tidewater.functions.partitions import (
    derive_partition_columns,
    partition_filter,
    partition_key_strings,
    partition_path,
    partition_predicate_frame,
)
from tidewater.functions.ranges import date_ranges
from tidewater.functions.stamps import change_stamp, column_defaults
from tidewater.operators.changes import change_window, has_changes_frame, latest_per_key
from tidewater.operators.inventory import collect_partitions, distinct_partitions, partition_inventory, preview
from tidewater.operators.merge import align_columns, merge_image, touched_partitions, unchanged_rows
from tidewater.operators.quality import (
    Constraints,
    ForeignKey,
    dq_allowed_values,
    dq_decimal_fit,
    dq_foreign_key,
    dq_max_length,
    dq_not_null,
    dq_primary_key,
    dq_summary,
    dq_unique,
)
from tidewater.operators.staging import materialise
from tidewater.plans import cli
from tidewater.plans.checks import dq_foreign_key_changed, dq_unique_changed
from tidewater.plans.compaction import compact_table
from tidewater.plans.context import EngineContext
from tidewater.plans.evolution import read_table
from tidewater.plans.jobs import append_changes, insert_table, prepare_and_save, refresh_table, run_action, update_table, upsert_changes
from tidewater.plans.marks import insert_new_rows
from tidewater.plans.specs import TableSpec
from tidewater.session import scratch_path
from tidewater.sinks.lake import lake_append, lake_replace, lake_replace_where
from tidewater.sources.catalog import scan_one_or_many, table_counts
from tidewater.sources.files import FrameSource, ParquetSource
from tidewater.sources.lake import lake_exists, lake_partition_scan, lake_scan
from tidewater.streaming.bookmark import export_changes, ingest_changes

# The training-data operators are a subpackage that the rest does without.
try:
    import corpus_pipeline
    from tidewater.llm.queries import ORACLES as _LLM_ORACLES
    from tidewater.llm.queries import QUERIES as _LLM_QUERIES
except ImportError:
    _LLM_QUERIES, _LLM_ORACLES = {}, {}
else:
    _LLM_QUERIES = {**_LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        _LLM_ORACLES = {**_LLM_ORACLES, "pipeline": corpus_pipeline.ORACLE_SQL}

SMOKE_DIR = "/root/testdata/sf0.001"
DAY = ("year", "month", "day")

# Fixed values of the scenario (see module docstring).
LOAD_CUTOFF = dt.datetime(2024, 1, 25)
UPDATE_AS_OF = dt.date(2024, 1, 25)
BACKFILL_DAY = dt.date(2024, 1, 10)
BACKFILL_STAMP = dt.datetime(2024, 1, 25, 6, 0, 0)
ALLOWED_EVENT_TYPES = ("view", "click", "purchase", "signup")

EVENTS_SPEC = TableSpec("events", ("event_id",), created_column="ts", change_column="last_updated_at")
EVENTS_MOVING_SPEC = TableSpec("events", ("event_id",), created_column="ts",
                               change_column="last_updated_at", partition_column="last_updated_at")

EVENTS_FLAT_SPEC = TableSpec("events", ("event_id",), change_column="last_updated_at")  # not partitioned

# Partitioning of the driver's tables for a full refresh: day grain for the event stream,
# month grain for the order facts (day grain would mean thousands of tiny files).
TESTDATA_TABLES = {
    "events": TableSpec("events", ("event_id",), created_column="ts"),
    "orders": TableSpec("orders", ("o_orderkey",), created_column="o_orderdate", grain="month"),
    "lineitem": TableSpec("lineitem", (), created_column="l_shipdate", grain="month"),
}
TESTDATA_TABLE_NAMES = ("benchmark", "conversations", "customer", "documents", "embeddings", "events",
                        "labels", "lineitem", "nation", "orders", "pages", "part", "region", "supplier")


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(value: dt.datetime):
    # Parsed from text: a zone-free literal whatever the session and process time zones.
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def events_loaded(spark, sf_dir) -> DataFrame:
    """What the source held at load time: events created before the cutoff."""
    ev = _t(spark, sf_dir, "events")
    return ev.where(F.col("ts") < _ntz(LOAD_CUTOFF)).withColumn("last_updated_at", F.col("ts"))


def events_changed(spark, sf_dir) -> DataFrame:
    """The source after the edits: every event, with edited values and change stamps."""
    ev = _t(spark, sf_dir, "events")
    purchase = F.col("event_type") == "purchase"
    stamp = (F.when(F.col("ts").cast("date") == F.lit(BACKFILL_DAY), _ntz(BACKFILL_STAMP))
             .when(purchase, F.col("ts") + F.expr("INTERVAL 10 DAYS"))
             .otherwise(F.col("ts")))
    return ev.select("event_id", "ts", "user_id", "event_type",
                     F.when(purchase, F.col("value") + 1000).otherwise(F.col("value")).alias("value"),
                     "props", stamp.alias("last_updated_at"))


def _changes(spark, sf_dir) -> DataFrame:
    return change_window(events_changed(spark, sf_dir), "last_updated_at", UPDATE_AS_OF, 1)


def _lake_ctx(spark, label, source, tables) -> EngineContext:
    return EngineContext(spark, source, scratch_path(spark, "lake", label), tables)


# ---------------------------------------------------------------- scans and projections

def q_source_scan(spark, sf_dir):
    return ParquetSource(spark, sf_dir).table("events")


def q_derive_partition_columns(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return derive_partition_columns(orders, "o_orderdate").drop("o_orderdate")


def q_partition_key_strings(spark, sf_dir):
    ev = derive_partition_columns(_t(spark, sf_dir, "events"), "ts")
    return partition_key_strings(ev, DAY).distinct()


def q_distinct_partitions(spark, sf_dir):
    li = derive_partition_columns(_t(spark, sf_dir, "lineitem"), "l_shipdate")
    return distinct_partitions(li, DAY)


def q_partition_predicate(spark, sf_dir):
    return partition_predicate_frame(derive_partition_columns(_changes(spark, sf_dir), "ts"), DAY)


def q_partition_path(spark, sf_dir):
    chg = derive_partition_columns(_changes(spark, sf_dir), "ts")
    return chg.select(partition_path(DAY).alias("full_path")).distinct()


def q_preview(spark, sf_dir):
    # A preview is a limit by definition; ordered so that it is deterministic.
    return preview(_t(spark, sf_dir, "events"), 20, order_by=["event_id"])


def q_table_counts(spark, sf_dir):
    return table_counts(ParquetSource(spark, sf_dir), TESTDATA_TABLE_NAMES)


# ---------------------------------------------------------------- change sets

def q_change_window(spark, sf_dir):
    return change_window(_t(spark, sf_dir, "events"), "ts", dt.date(2024, 1, 15), 1)


def q_change_window_bounds(spark, sf_dir):
    # Midnight stamps sit exactly on the bounds: both ends must be exclusive.
    return change_window(_t(spark, sf_dir, "orders"), "o_orderdate", dt.date(1998, 1, 15), 1)


def q_has_changes(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    hit = has_changes_frame(change_window(ev, "ts", dt.date(2024, 1, 15), 1))
    miss = has_changes_frame(change_window(ev, "ts", dt.date(2023, 6, 1), 1))
    return (hit.select(F.lit("2024-01-15").alias("as_of"), "has_changes")
            .unionByName(miss.select(F.lit("2023-06-01").alias("as_of"), "has_changes")))


def q_latest_per_key(spark, sf_dir):
    both = events_changed(spark, sf_dir).unionByName(
        _t(spark, sf_dir, "events").withColumn("last_updated_at", F.col("ts")))
    return latest_per_key(both, ["event_id"], "last_updated_at")


def q_materialise(spark, sf_dir):
    # The staged copy is returned, so its folder is left for the caller to read.
    return materialise(_changes(spark, sf_dir), label="query").df


def q_change_stamp(spark, sf_dir):
    cust = (_t(spark, sf_dir, "customer").select("c_custkey")
            .withColumn("last_updated_at", _ntz(dt.datetime(2024, 1, 1))))
    ordered = change_window(_t(spark, sf_dir, "orders"), "o_orderdate", dt.date(1998, 1, 15), 3)
    return change_stamp(cust, ordered.select(F.col("o_custkey").alias("c_custkey")), ["c_custkey"],
                        "last_updated_at", dt.datetime(2024, 1, 15))


def q_column_defaults(spark, sf_dir):
    cust = _t(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("status"))
    return column_defaults(cust, {"status": "OPEN"})


# ---------------------------------------------------------------- merge building blocks

def _base_with_partitions(spark, sf_dir):
    return derive_partition_columns(events_loaded(spark, sf_dir), "ts")


def q_touched_partitions(spark, sf_dir):
    return touched_partitions(_base_with_partitions(spark, sf_dir), _changes(spark, sf_dir),
                              ["event_id"], DAY)


def q_unchanged_rows(spark, sf_dir):
    return unchanged_rows(events_loaded(spark, sf_dir), _changes(spark, sf_dir), ["event_id"])


def q_merge_image(spark, sf_dir):
    chg = derive_partition_columns(_changes(spark, sf_dir), "ts")
    return merge_image(_base_with_partitions(spark, sf_dir), chg, ["event_id"])


def q_align_columns(spark, sf_dir):
    chg = _changes(spark, sf_dir)
    shuffled = chg.select("last_updated_at", F.lit("batch-1").alias("batch"), "value", "event_type",
                          "user_id", "ts", "event_id")  # extra column, props missing, new order
    return align_columns(shuffled, events_loaded(spark, sf_dir).schema, fill_missing=True)


# ---------------------------------------------------------------- lake writes

def q_refresh_table(spark, sf_dir):
    src = FrameSource({"events": lambda: events_changed(spark, sf_dir)})
    ctx = _lake_ctx(spark, "refresh", src, {"events": EVENTS_SPEC})
    refresh_table(ctx, "events")  # a differently filled lake first
    ctx.source = FrameSource({"events": lambda: _t(spark, sf_dir, "events")})
    refresh_table(ctx, "events")
    return lake_scan(spark, ctx.table_path("events"))


def q_lake_replace(spark, sf_dir):
    path = scratch_path(spark, "lake", "replace")
    orders = _t(spark, sf_dir, "orders")
    lake_replace(derive_partition_columns(orders.where(F.col("o_orderstatus") == "F"), "o_orderdate", "month"),
                 path, ["year", "month"])
    lake_replace(derive_partition_columns(orders, "o_orderdate", "month"), path, ["year", "month"])
    return lake_scan(spark, path)


def q_lake_append(spark, sf_dir):
    path = scratch_path(spark, "lake", "append")
    ev = derive_partition_columns(_t(spark, sf_dir, "events"), "ts")
    lake_append(ev, path, DAY)
    lake_append(ev, path, DAY)
    return lake_scan(spark, path)


def q_lake_replace_where(spark, sf_dir):
    path = scratch_path(spark, "lake", "replace-where")
    ev = derive_partition_columns(_t(spark, sf_dir, "events"), "ts")
    lake_replace(ev, path, DAY)
    days34 = (F.col("year") == 2024) & (F.col("month") == 1) & F.col("day").isin(3, 4)
    fresh = (lake_scan(spark, path).where(days34 & (F.col("event_type") == "purchase"))
             .withColumn("value", F.col("value") * 2))
    lake_replace_where(fresh, path, DAY)
    return lake_scan(spark, path)


def q_lake_scan(spark, sf_dir):
    path = scratch_path(spark, "lake", "scan")
    lake_replace(derive_partition_columns(_t(spark, sf_dir, "events"), "ts"), path, DAY)
    return lake_scan(spark, path)


def q_lake_partition_scan(spark, sf_dir):
    ctx = _lake_ctx(spark, "partition-scan", ParquetSource(spark, sf_dir), TESTDATA_TABLES)
    refresh_table(ctx, "events")
    return lake_partition_scan(spark, ctx.table_path("events"), [(2024, 1, 3), (2024, 1, 4), (2024, 2, 1)], DAY)


def q_partition_inventory(spark, sf_dir):
    ctx = _lake_ctx(spark, "inventory", ParquetSource(spark, sf_dir), TESTDATA_TABLES)
    refresh_table(ctx, "events")
    return partition_inventory(lake_scan(spark, ctx.table_path("events")), DAY)


def q_null_partition(spark, sf_dir):
    # Error events carry no creation time: they land in the NULL partition.
    ev = _t(spark, sf_dir, "events").withColumn(
        "created_at", F.when(F.col("event_type") != "error", F.col("ts")))
    src = FrameSource({"events": ev})
    ctx = _lake_ctx(spark, "null-partition", src, {"events": TableSpec("events", ("event_id",), "created_at")})
    refresh_table(ctx, "events")
    return partition_inventory(lake_scan(spark, ctx.table_path("events")), DAY)


def q_insert_table(spark, sf_dir):
    ctx = _lake_ctx(spark, "insert", ParquetSource(spark, sf_dir), TESTDATA_TABLES)
    insert_table(ctx, "events", dt.date(2024, 1, 15), 1)
    insert_table(ctx, "events", dt.date(2024, 1, 16), 1)  # overlaps 2024-01-15: kept twice
    return lake_scan(spark, ctx.table_path("events"))


def q_insert_dedupe(spark, sf_dir):
    ctx = _lake_ctx(spark, "insert-dedupe", ParquetSource(spark, sf_dir), TESTDATA_TABLES)
    insert_table(ctx, "events", dt.date(2024, 1, 15), 1, dedupe_on_key=True)
    insert_table(ctx, "events", dt.date(2024, 1, 16), 1, dedupe_on_key=True)
    return lake_scan(spark, ctx.table_path("events"))


def _update(spark, sf_dir, spec: TableSpec, label: str) -> DataFrame:
    ctx = _lake_ctx(spark, label, FrameSource({"events": lambda: events_loaded(spark, sf_dir)}),
                    {"events": spec})
    refresh_table(ctx, "events")
    ctx.source = FrameSource({"events": lambda: events_changed(spark, sf_dir)})
    update_table(ctx, "events", UPDATE_AS_OF, 1)
    return lake_scan(spark, ctx.table_path("events"))


def q_update_table(spark, sf_dir):
    return _update(spark, sf_dir, EVENTS_SPEC, "update")


def q_update_moving_rows(spark, sf_dir):
    # Partitioned by the change stamp: changed rows move, the backfilled day empties.
    return _update(spark, sf_dir, EVENTS_MOVING_SPEC, "update-moving")


def q_update_moving_inventory(spark, sf_dir):
    return partition_inventory(_update(spark, sf_dir, EVENTS_MOVING_SPEC, "update-moving-inv"), DAY)


def q_update_rerun(spark, sf_dir):
    ctx = _lake_ctx(spark, "update-rerun", FrameSource({"events": lambda: events_loaded(spark, sf_dir)}),
                    {"events": EVENTS_MOVING_SPEC})
    refresh_table(ctx, "events")
    ctx.source = FrameSource({"events": lambda: events_changed(spark, sf_dir)})
    update_table(ctx, "events", UPDATE_AS_OF, 1)
    update_table(ctx, "events", UPDATE_AS_OF, 1)  # same change set again: no effect
    return lake_scan(spark, ctx.table_path("events"))


def _content(spark, tables: dict) -> DataFrame:
    """(table_name, column_name, n, distinct_values, low, high) of every column: values in the
    column, different ones, and the least and greatest of text lengths, array lengths, seconds
    or numbers."""
    out = None
    for name, df in tables.items():
        sizes = []
        for f in df.schema.fields:
            kind, c = f.dataType.typeName(), F.col(f.name)
            size = {"string": F.length(c), "array": F.size(c)}.get(kind)
            if kind.startswith("timestamp") or kind == "date":
                size = F.unix_seconds(c.cast("timestamp"))
            sizes.append(F.struct(F.lit(f.name).alias("column_name"), F.count(c).alias("n"), F.count_distinct(c).alias("distinct_values"),
                                  F.min((c if size is None else size).cast("double")).alias("low"),
                                  F.max((c if size is None else size).cast("double")).alias("high")))
        one = df.agg(F.array(*sizes).alias("c")).select(F.lit(name).alias("table_name"), F.explode("c").alias("c")).select("table_name", "c.*")
        out = one if out is None else out.unionByName(one)
    return out


def _content_sql(names, where: dict[str, str] | None = None) -> str:
    """The same in SQL; column names and types are those of the smallest test tables. ``where``
    gives conditions on tables."""
    import pyarrow.parquet as pq

    parts = []
    for t in names:
        rows = f"{t} WHERE {where[t]}" if where else t
        for f in pq.read_schema(f"{SMOKE_DIR}/{t}.parquet"):
            kind = str(f.type)
            size = f'"{f.name}"'
            if "string" in kind:
                size = f'length("{f.name}")'
            elif kind.startswith(("list", "large_list")):
                size = f'len("{f.name}")'
            elif kind.startswith(("timestamp", "date")):
                size = f'floor(epoch("{f.name}"))'
            parts.append(f"""SELECT '{t}' AS table_name, '{f.name}' AS column_name, COUNT("{f.name}") AS n,
                COUNT(DISTINCT "{f.name}") AS distinct_values, CAST(MIN({size}) AS DOUBLE) AS low, CAST(MAX({size}) AS DOUBLE) AS high FROM {rows}""")
    return " UNION ALL ".join(parts)


def q_update_full(spark, sf_dir):
    # Both mutable tables, found in the source, by one run; its rows are those of update_table
    # and update_orders_month at day grain.
    source = FrameSource({"events": lambda: events_loaded(spark, sf_dir), "orders": lambda: orders_loaded(spark, sf_dir)})
    orders = TableSpec("orders", ("o_orderkey",), "o_orderdate", "last_updated_at", grain="month")
    ctx = _lake_ctx(spark, "update-full", source, {"events": EVENTS_SPEC, "orders": orders})
    run_action(ctx, "refresh", "full")
    ctx.source = FrameSource({"events": lambda: events_changed(spark, sf_dir), "orders": lambda: orders_changed(spark, sf_dir)})
    run_action(ctx, "update", "full", as_of=UPDATE_AS_OF, days=1)
    run_action(ctx, "update", "full", as_of=dt.date(1998, 1, 15), days=15)
    events, lake_orders = lake_scan(spark, ctx.table_path("events")), lake_scan(spark, ctx.table_path("orders"))
    shape = lambda df, name, key, value: df.select(F.lit(name).alias("table_name"), F.col(key).alias("id"), F.col(value).alias("value"),
                                                   "last_updated_at", "partition_date")
    return shape(events, "events", "event_id", "value").unionByName(shape(lake_orders, "orders", "o_orderkey", "o_totalprice"))


def q_update_unpartitioned(spark, sf_dir):
    return _update(spark, sf_dir, EVENTS_FLAT_SPEC, "update-unpartitioned")


def _update_with(spark, sf_dir, label, changes: DataFrame, spec: TableSpec | None = None, **options) -> DataFrame:
    """The loaded lake after one upsert of ``changes``."""
    ctx = _lake_ctx(spark, label, FrameSource({"events": lambda: events_loaded(spark, sf_dir)}), {"events": spec or EVENTS_SPEC})
    refresh_table(ctx, "events")
    upsert_changes(ctx, "events", changes, **options)
    return lake_scan(spark, ctx.table_path("events"))


def q_update_corrected_created(spark, sf_dir):
    # The changed purchases also get another created stamp: each key's row moves, once.
    moved = F.when(F.col("event_type") == "purchase", F.col("ts") + F.expr("INTERVAL 2 DAYS")).otherwise(F.col("ts"))
    return _update_with(spark, sf_dir, "update-corrected", _changes(spark, sf_dir).withColumn("ts", moved))


def q_update_null_partition(spark, sf_dir):
    # The changed purchases lose their created stamp: they move to the NULL partition.
    lost = F.when(F.col("event_type") != "purchase", F.col("ts"))
    return _update_with(spark, sf_dir, "update-null", _changes(spark, sf_dir).withColumn("ts", lost))


def q_update_latest_only(spark, sf_dir):
    # Every change row arrives in two versions; the later one counts.
    chg = _changes(spark, sf_dir)
    older = chg.withColumn("last_updated_at", F.col("last_updated_at") - F.expr("INTERVAL 1 HOUR")).withColumn("value", F.lit(-1.0))
    return _update_with(spark, sf_dir, "update-latest", chg.unionByName(older), latest_only=True)


def q_update_stale_rows(spark, sf_dir):
    # Half of the change rows are older than the lake's versions and must not win.
    old = F.when(F.col("event_id") % 2 == 0, F.col("ts") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("last_updated_at"))
    return _update_with(spark, sf_dir, "update-stale", _changes(spark, sf_dir).withColumn("last_updated_at", old))


def q_stream_late_file(spark, sf_dir):
    # A change file whose time stamp is nine days behind the newest one seen is still read.
    ctx = _lake_ctx(spark, "stream-late", FrameSource({"events": lambda: events_loaded(spark, sf_dir)}), {"events": EVENTS_SPEC})
    refresh_table(ctx, "events")
    ctx.source = FrameSource({"events": lambda: events_changed(spark, sf_dir)})
    drop = scratch_path(spark, "drop", "events-late")
    schema = events_changed(spark, sf_dir).schema
    seen: set = set()
    for as_of, days_behind in ((UPDATE_AS_OF, 0), (dt.date(2024, 2, 10), 9)):
        export_changes(ctx, "events", drop, as_of, 1)
        files = set(fs.data_files(spark, drop))
        for f in files - seen:
            fs.set_modification_time(spark, f, fs.modification_time(spark, f) - days_behind * 86_400_000)
        seen = files
        ingest_changes(ctx, "events", drop, schema, action="update")
    return lake_scan(spark, ctx.table_path("events"))


def q_refresh_full(spark, sf_dir):
    ctx = _lake_ctx(spark, "refresh-full", ParquetSource(spark, sf_dir), TESTDATA_TABLES)
    run_action(ctx, "refresh", "full")
    return _content(spark, {t: lake_scan(spark, ctx.table_path(t)).select(_t(spark, sf_dir, t).columns) for t in TESTDATA_TABLE_NAMES})


def q_update_insert_only(spark, sf_dir):
    # The 2024-02-10 window holds only purchases created 2024-01-30: keys and partitions
    # the lake does not have yet.
    ctx = _lake_ctx(spark, "update-insert-only", FrameSource({"events": lambda: events_loaded(spark, sf_dir)}),
                    {"events": EVENTS_SPEC})
    refresh_table(ctx, "events")
    ctx.source = FrameSource({"events": lambda: events_changed(spark, sf_dir)})
    update_table(ctx, "events", dt.date(2024, 2, 10), 1)
    return lake_scan(spark, ctx.table_path("events"))


def _backfilled(spark, sf_dir) -> DataFrame:
    """The source after a backfill of one day; every other day is as it was."""
    stamp = F.when(F.col("ts").cast("date") == F.lit(BACKFILL_DAY), _ntz(BACKFILL_STAMP)).otherwise(F.col("ts"))
    return _t(spark, sf_dir, "events").withColumn("last_updated_at", stamp)


def _refresh_changed(spark, sf_dir, label):
    ctx = _lake_ctx(spark, label, FrameSource({"events": lambda: events_loaded(spark, sf_dir)}), {"events": EVENTS_SPEC})
    refresh_table(ctx, "events")
    ctx.source = FrameSource({"events": lambda: _backfilled(spark, sf_dir)})
    return ctx, refresh_table(ctx, "events", changed_only=True)


def q_refresh_changed_partitions(spark, sf_dir):
    ctx, _ = _refresh_changed(spark, sf_dir, "refresh-changed")
    return lake_scan(spark, ctx.table_path("events"))


def q_refresh_changed_days(spark, sf_dir):
    # Which days of the lake the refresh rewrote: the backfilled one and the new ones.
    ctx, result = _refresh_changed(spark, sf_dir, "refresh-changed-days")
    inventory = partition_inventory(lake_scan(spark, ctx.table_path("events")), DAY)
    return inventory.withColumn("rewritten", partition_filter(result.affected_partitions, DAY))


def q_update_key_in_two_days(spark, sf_dir):
    # Purchases of three days were inserted once more under later days; those that then change have
    # one row afterwards, found through the files' key filters.
    ctx = _lake_ctx(spark, "update-two-days", FrameSource({"events": lambda: events_loaded(spark, sf_dir)}), {"events": EVENTS_SPEC})
    ctx.key_filter_min_bytes = 0
    refresh_table(ctx, "events")
    base = events_loaded(spark, sf_dir)
    again = base.where((F.col("event_type") == "purchase") & (F.col("ts") >= _ntz(dt.datetime(2024, 1, 13))) & (F.col("ts") < _ntz(dt.datetime(2024, 1, 16))))
    append_changes(ctx, "events", again.withColumn("ts", F.col("ts") + F.expr("INTERVAL 3 DAYS")))
    upsert_changes(ctx, "events", _changes(spark, sf_dir))
    return lake_scan(spark, ctx.table_path("events"))


def q_insert_rerun(spark, sf_dir):
    # Every window is run twice and adds its rows once; the windows overlap by a day.
    ctx = _lake_ctx(spark, "insert-rerun", ParquetSource(spark, sf_dir), TESTDATA_TABLES)
    for day in (15, 15, 16, 15, 16):
        run_action(ctx, "insert", "partial", "events", as_of=dt.date(2024, 1, day))
    return lake_scan(spark, ctx.table_path("events"))


def q_insert_from_mark(spark, sf_dir):
    # Three irregular runs, each twice; clicks of the first run's last day reach the source late.
    ev = _t(spark, sf_dir, "events")
    cut, late = F.col("ts") < _ntz(dt.datetime(2024, 1, 12)), (F.col("event_type") == "click") & (F.col("ts") >= _ntz(dt.datetime(2024, 1, 11)))
    ctx = _lake_ctx(spark, "insert-mark", FrameSource({}), TESTDATA_TABLES)
    for source in (ev.where(cut & ~late), ev.where(F.col("ts") < _ntz(dt.datetime(2024, 1, 13, 7))), ev):
        ctx.source = FrameSource({"events": source})
        insert_new_rows(ctx, "events")
        insert_new_rows(ctx, "events")
    return lake_scan(spark, ctx.table_path("events"))


def q_compact_table(spark, sf_dir):
    # Five appends leave five files a day; compacted, each day is one file with the same rows.
    ctx = _lake_ctx(spark, "compact", ParquetSource(spark, sf_dir), TESTDATA_TABLES)
    ev = _t(spark, sf_dir, "events")
    for kind in (*ALLOWED_EVENT_TYPES, "error"):
        append_changes(ctx, "events", ev.where(F.col("event_type") == kind))
    compact_table(ctx, "events")
    lake = lake_scan(spark, ctx.table_path("events")).withColumn("file", F.col("_metadata.file_path"))
    return lake.groupBy(*DAY).agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("decimal(18,2)").alias("total"), F.count_distinct("file").alias("files"))


def q_write_clustered(spark, sf_dir):
    spec = TableSpec("orders", ("o_orderkey",), "o_orderdate", grain="year", cluster_by=("o_custkey", "o_totalprice", "o_orderpriority"))
    ctx = _lake_ctx(spark, "clustered", ParquetSource(spark, sf_dir), {"orders": spec})
    refresh_table(ctx, "orders")
    return lake_scan(spark, ctx.table_path("orders"))


def q_evolve_columns(spark, sf_dir):
    # Early events have no props and a narrow user id; later ones bring both.
    ctx = _lake_ctx(spark, "evolve", FrameSource({}), {"events": TableSpec("events", ("event_id",), created_column="ts", evolve=True)})
    ev = _t(spark, sf_dir, "events")
    early = F.col("ts") < _ntz(LOAD_CUTOFF)
    append_changes(ctx, "events", ev.where(early).drop("props").withColumn("user_id", F.col("user_id").cast("int")))
    append_changes(ctx, "events", ev.where(~early).withColumn("user_id", F.col("user_id").cast("long")))
    return read_table(ctx, "events")


def q_dq_unique_changed(spark, sf_dir):
    # One day's events came again under another day; the check
    # reads that day and the files that may hold its keys.
    ctx = _lake_ctx(spark, "unique-changed", ParquetSource(spark, sf_dir), TESTDATA_TABLES)
    refresh_table(ctx, "events")
    ev = _t(spark, sf_dir, "events")
    moved = ev.where(F.col("ts").cast("date") == F.lit(dt.date(2024, 1, 10))).withColumn("ts", F.col("ts") + F.expr("INTERVAL 20 DAYS"))
    append_changes(ctx, "events", moved)
    return dq_unique_changed(ctx, "events", ["event_id"], [(2024, 1, 30)])


def q_dq_foreign_key_changed(spark, sf_dir):
    # The customers of a nation left, and a month's orders came again for customers that don't exist; the
    # check reads that month, the keys that left, and the files that may hold either.
    ctx = _lake_ctx(spark, "references-changed", ParquetSource(spark, sf_dir), {**TESTDATA_TABLES, "customer": TableSpec("customer", ("c_custkey",))})
    refresh_table(ctx, "orders")
    refresh_table(ctx, "customer")
    customers = _t(spark, sf_dir, "customer")
    ctx.source = FrameSource({"customer": customers.where(F.col("c_nationkey") != 7)})
    refresh_table(ctx, "customer")
    month = _t(spark, sf_dir, "orders").where((F.year("o_orderdate") == 1996) & (F.month("o_orderdate") == 2))
    append_changes(ctx, "orders", month.withColumns({"o_orderkey": -F.col("o_orderkey"), "o_custkey": -F.col("o_custkey")}))
    return dq_foreign_key_changed(ctx, "orders", "customer", ["o_custkey"], ["c_custkey"], [(1996, 2)], removed=customers.where(F.col("c_nationkey") == 7))


def q_job_entry(spark, sf_dir):
    # The command line over files: a refresh of orders, and an insert of events run twice.
    lake = scratch_path(spark, "lake", "job-entry")
    with tempfile.NamedTemporaryFile("w", suffix=".json") as tables:
        json.dump([{"name": "events", "keys": ["event_id"], "created_column": "ts"},
                   {"name": "orders", "keys": ["o_orderkey"], "created_column": "o_orderdate", "grain": "month"}], tables)
        tables.flush()
        common = ["--mode", "partial", "--source", "parquet", "--source-path", sf_dir, "--lake-root", lake, "--tables-json", tables.name]
        for job in (["--action", "refresh", "--table", "orders"], *[["--action", "insert", "--table", "events", "--as-of", "2024-01-15", "--days", "3"]] * 2):
            with contextlib.redirect_stdout(io.StringIO()):
                if cli.main([*job, *common]):
                    raise RuntimeError(f"job failed: {job}")
    shape = lambda name, key: lake_scan(spark, f"{lake}/{name}").select(F.lit(name).alias("table_name"), F.col(key).alias("id"), "partition_date")
    return shape("events", "event_id").unionByName(shape("orders", "o_orderkey"))


def q_partition_ranges(spark, sf_dir):
    pending = _t(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "P")
    return date_ranges(derive_partition_columns(pending, "o_orderdate"))


def q_update_no_change(spark, sf_dir):
    ctx = _lake_ctx(spark, "update-no-change", FrameSource({"events": lambda: events_loaded(spark, sf_dir)}),
                    {"events": EVENTS_SPEC})
    refresh_table(ctx, "events")
    ctx.source = FrameSource({"events": lambda: events_changed(spark, sf_dir)})
    update_table(ctx, "events", dt.date(2023, 6, 1), 1)
    return lake_scan(spark, ctx.table_path("events"))


def q_stream_update(spark, sf_dir):
    # Two scheduled runs of the streaming ingest; each sees only the files exported since
    # the previous run (the checkpoint is the bookmark).
    ctx = _lake_ctx(spark, "stream-update", FrameSource({"events": lambda: events_loaded(spark, sf_dir)}),
                    {"events": EVENTS_SPEC})
    refresh_table(ctx, "events")
    ctx.source = FrameSource({"events": lambda: events_changed(spark, sf_dir)})
    drop = scratch_path(spark, "drop", "events")
    schema = events_changed(spark, sf_dir).schema
    for as_of in (UPDATE_AS_OF, dt.date(2024, 2, 10)):
        export_changes(ctx, "events", drop, as_of, 1)
        ingest_changes(ctx, "events", drop, schema, action="update")
    return lake_scan(spark, ctx.table_path("events"))


def q_stream_insert(spark, sf_dir):
    ctx = _lake_ctx(spark, "stream-insert", ParquetSource(spark, sf_dir), TESTDATA_TABLES)
    drop = scratch_path(spark, "drop", "events-created")
    schema = _t(spark, sf_dir, "events").schema
    for as_of in (dt.date(2024, 1, 15), dt.date(2024, 1, 16)):  # overlapping windows
        export_changes(ctx, "events", drop, as_of, 1, role="created")
        ingest_changes(ctx, "events", drop, schema, action="insert")
    return lake_scan(spark, ctx.table_path("events"))


def q_insert_full(spark, sf_dir):
    ctx = _lake_ctx(spark, "insert-full", ParquetSource(spark, sf_dir), TESTDATA_TABLES)
    run_action(ctx, "insert", "full", as_of=dt.date(1998, 1, 15), days=1)
    lake = ParquetSource(spark, ctx.lake_root, suffix="")
    present = [n for n in lake.list_tables() if lake_exists(spark, ctx.table_path(n))]
    return _content(spark, {t: lake.table(t).select(_t(spark, sf_dir, t).columns) for t in present})


def q_scan_one_or_many(spark, sf_dir):
    frames = scan_one_or_many(ParquetSource(spark, sf_dir), table_list=list(TESTDATA_TABLE_NAMES))
    out = None
    for name, df in frames.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def q_partition_prune(spark, sf_dir):
    ctx = _lake_ctx(spark, "prune", ParquetSource(spark, sf_dir), TESTDATA_TABLES)
    refresh_table(ctx, "events")
    changed = collect_partitions(derive_partition_columns(_changes(spark, sf_dir), "ts"), DAY)
    return lake_scan(spark, ctx.table_path("events")).where(partition_filter(changed, DAY))


def q_prepare_and_save(spark, sf_dir):
    ctx = _lake_ctx(spark, "prepare", ParquetSource(spark, sf_dir), TESTDATA_TABLES)
    prepare_and_save(ctx, _t(spark, sf_dir, "lineitem"), TESTDATA_TABLES["lineitem"], "overwrite")
    return lake_scan(spark, ctx.table_path("lineitem"))


ORDERS_SPEC = TableSpec("orders", ("o_orderkey",), created_column="o_orderdate",
                        change_column="last_updated_at", grain="month")


def orders_loaded(spark, sf_dir) -> DataFrame:
    return _t(spark, sf_dir, "orders").withColumn("last_updated_at", F.col("o_orderdate"))


def orders_changed(spark, sf_dir) -> DataFrame:
    """Pending orders were re-priced and stamped 30 days after they were placed."""
    o = _t(spark, sf_dir, "orders")
    pending = F.col("o_orderstatus") == "P"
    return o.select("o_orderkey", "o_custkey", "o_orderstatus",
                    F.when(pending, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
                    "o_orderdate", "o_orderpriority",
                    F.when(pending, F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS"))
                    .otherwise(F.col("o_orderdate")).alias("last_updated_at"))


def q_update_orders_month(spark, sf_dir):
    # A second table at month grain, over a 15-day window around 1998-01-15.
    ctx = _lake_ctx(spark, "update-orders", FrameSource({"orders": lambda: orders_loaded(spark, sf_dir)}),
                    {"orders": ORDERS_SPEC})
    refresh_table(ctx, "orders")
    ctx.source = FrameSource({"orders": lambda: orders_changed(spark, sf_dir)})
    update_table(ctx, "orders", dt.date(1998, 1, 15), 15)
    return lake_scan(spark, ctx.table_path("orders"))


# ---------------------------------------------------------------- quality checks

def q_dq_not_null(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id")
    labelled = docs.join(_t(spark, sf_dir, "labels"), "doc_id", "left")
    return dq_not_null(labelled, ["quality", "toxic"])


def q_dq_primary_key(spark, sf_dir):
    return dq_primary_key(_t(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_dq_unique(spark, sf_dir):
    return dq_unique(_t(spark, sf_dir, "part"), ["p_name"])


def q_dq_foreign_key(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return dq_foreign_key(docs, _t(spark, sf_dir, "labels"), ["doc_id"])


def q_dq_foreign_key_orders(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return dq_foreign_key(orders, _t(spark, sf_dir, "customer"), ["o_custkey"], ["c_custkey"])


def q_dq_foreign_key_parts(spark, sf_dir):
    # Part numbers are no supplier numbers: those beyond the suppliers' are hits.
    items = _t(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return dq_foreign_key(items, _t(spark, sf_dir, "supplier"), ["l_partkey"], ["s_suppkey"])


def q_dq_allowed_values(spark, sf_dir):
    ev = _t(spark, sf_dir, "events").select("event_id", "event_type")
    return dq_allowed_values(ev, "event_type", ALLOWED_EVENT_TYPES)


def q_dq_max_length(spark, sf_dir):
    return dq_max_length(_t(spark, sf_dir, "documents").select("doc_id", "source"), "source", 4)


def q_dq_decimal_fit(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("charge"))
    return dq_decimal_fit(li, "charge", 15, 2)


# The lineitem rule set: the columns' NOT NULL / key / value-list / width / reference rules,
# plus a derived charge that must fit NUMERIC(15,2).
LINEITEM_RULES = Constraints(
    not_null=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
              "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"),
    primary_key=("l_orderkey", "l_linenumber"),
    allowed={"l_returnflag": ("A", "N", "R"), "l_linestatus": ("F", "O")},
    max_length={"l_returnflag": 1, "l_linestatus": 1},
    decimal={"l_extendedprice": (15, 2), "charge": (15, 2)},
    references=(ForeignKey(("l_orderkey",), "orders", ("o_orderkey",)),
                ForeignKey(("l_partkey",), "part", ("p_partkey",)),
                ForeignKey(("l_suppkey",), "supplier", ("s_suppkey",))),
)


def q_dq_summary(spark, sf_dir):
    li = _t(spark, sf_dir, "lineitem").withColumn(
        "charge", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    parents = {n: _t(spark, sf_dir, n) for n in ("orders", "part", "supplier")}
    return dq_summary(li, LINEITEM_RULES, parents)


def _dq_summary_sql(c: Constraints) -> str:
    parts = [f"SELECT 'not_null' AS rule, '{col}' AS columns, COUNT(*) FILTER (WHERE {col} IS NULL) AS violations FROM li"
             for col in c.not_null]
    for col, values in c.allowed.items():
        vals = ", ".join(f"'{v}'" for v in values)
        parts.append(f"SELECT 'allowed_values', '{col}', COUNT(*) FILTER (WHERE {col} NOT IN ({vals})) FROM li")
    for col, n in c.max_length.items():
        parts.append(f"SELECT 'max_length', '{col}', COUNT(*) FILTER (WHERE length({col}) > {n}) FROM li")
    for col, (p, sc) in c.decimal.items():
        cast = f"TRY_CAST({col} AS DECIMAL({p}, {sc}))"
        parts.append(f"SELECT 'decimal_fit', '{col}', COUNT(*) FILTER (WHERE {col} IS NOT NULL AND "
                     f"({cast} IS NULL OR {cast} <> {col})) FROM li")
    keys = ", ".join(c.primary_key)
    parts.append(f"SELECT 'primary_key', '{','.join(c.primary_key)}', CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) "
                 f"FROM (SELECT COUNT(*) AS n FROM li GROUP BY {keys} HAVING COUNT(*) > 1)")
    for fk in c.references:
        (col,), (pcol,) = fk.columns, fk.parent_columns
        parts.append(f"SELECT 'foreign_key', '{col}', COUNT(*) FROM li WHERE {col} IS NOT NULL AND "
                     f"NOT EXISTS (SELECT 1 FROM {fk.parent} p WHERE p.{pcol} = li.{col})")
    return ("WITH li AS (SELECT *, l_extendedprice * (1 - l_discount) AS charge FROM lineitem)\n"
            + "\nUNION ALL ".join(parts))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "source_scan": q_source_scan,
    "derive_partition_columns": q_derive_partition_columns,
    "partition_key_strings": q_partition_key_strings,
    "distinct_partitions": q_distinct_partitions,
    "partition_predicate": q_partition_predicate,
    "partition_path": q_partition_path,
    "preview": q_preview,
    "table_counts": q_table_counts,
    "change_window": q_change_window,
    "change_window_bounds": q_change_window_bounds,
    "has_changes": q_has_changes,
    "latest_per_key": q_latest_per_key,
    "materialise": q_materialise,
    "change_stamp": q_change_stamp,
    "column_defaults": q_column_defaults,
    "touched_partitions": q_touched_partitions,
    "unchanged_rows": q_unchanged_rows,
    "merge_image": q_merge_image,
    "align_columns": q_align_columns,
    "refresh_table": q_refresh_table,
    "lake_replace": q_lake_replace,
    "lake_append": q_lake_append,
    "lake_replace_where": q_lake_replace_where,
    "lake_scan": q_lake_scan,
    "lake_partition_scan": q_lake_partition_scan,
    "partition_inventory": q_partition_inventory,
    "null_partition": q_null_partition,
    "insert_table": q_insert_table,
    "insert_dedupe": q_insert_dedupe,
    "update_table": q_update_table,
    "update_moving_rows": q_update_moving_rows,
    "update_moving_inventory": q_update_moving_inventory,
    "update_rerun": q_update_rerun,
    "refresh_full": q_refresh_full,
    "update_full": q_update_full,
    "update_unpartitioned": q_update_unpartitioned,
    "update_corrected_created": q_update_corrected_created,
    "update_null_partition": q_update_null_partition,
    "update_latest_only": q_update_latest_only,
    "update_stale_rows": q_update_stale_rows,
    "stream_late_file": q_stream_late_file,
    "dq_foreign_key_parts": q_dq_foreign_key_parts,
    "update_insert_only": q_update_insert_only,
    "refresh_changed_partitions": q_refresh_changed_partitions,
    "refresh_changed_days": q_refresh_changed_days,
    "update_key_in_two_days": q_update_key_in_two_days,
    "insert_rerun": q_insert_rerun,
    "insert_from_mark": q_insert_from_mark,
    "partition_ranges": q_partition_ranges,
    "job_entry": q_job_entry,
    "dq_unique_changed": q_dq_unique_changed,
    "dq_foreign_key_changed": q_dq_foreign_key_changed,
    "compact_table": q_compact_table,
    "write_clustered": q_write_clustered,
    "evolve_columns": q_evolve_columns,
    "update_no_change": q_update_no_change,
    "stream_update": q_stream_update,
    "stream_insert": q_stream_insert,
    "insert_full": q_insert_full,
    "scan_one_or_many": q_scan_one_or_many,
    "partition_prune": q_partition_prune,
    "prepare_and_save": q_prepare_and_save,
    "update_orders_month": q_update_orders_month,
    "dq_not_null": q_dq_not_null,
    "dq_primary_key": q_dq_primary_key,
    "dq_unique": q_dq_unique,
    "dq_foreign_key": q_dq_foreign_key,
    "dq_foreign_key_orders": q_dq_foreign_key_orders,
    "dq_allowed_values": q_dq_allowed_values,
    "dq_max_length": q_dq_max_length,
    "dq_decimal_fit": q_dq_decimal_fit,
    "dq_summary": q_dq_summary,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the copy-on-write update of the events lake on sf0.001."""
    return q_update_table(spark, SMOKE_DIR)


def _ship_package(spark: SparkSession) -> None:
    """Sends the package to Python workers that don't see this folder by themselves."""
    seen = [os.path.realpath(p) for p in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)) if p]
    if os.path.realpath(_HERE) in seen or getattr(spark.sparkContext, "_tidewater_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="tidewater-package-"), "tidewater_package")
    spark.sparkContext.addPyFile(shutil.make_archive(archive, "zip", _HERE, "tidewater"))
    spark.sparkContext._tidewater_shipped = True


def _on_workers(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        _ship_package(spark)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **{name: _on_workers(query) for name, query in _LLM_QUERIES.items()}}


# ---------------------------------------------------------------- DuckDB oracles

def _ymd(c: str) -> str:
    return (f"CAST({c} AS DATE) AS partition_date, CAST(year({c}) AS INT) AS year, "
            f"CAST(month({c}) AS INT) AS month, CAST(day({c}) AS INT) AS day")


_SRC = """src AS (
  SELECT event_id, ts, user_id, event_type,
         CASE WHEN event_type = 'purchase' THEN value + 1000 ELSE value END AS value,
         props,
         CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' THEN TIMESTAMP '2024-01-25 06:00:00'
              WHEN event_type = 'purchase' THEN ts + INTERVAL 10 DAY
              ELSE ts END AS last_updated_at
  FROM events)"""
_CHG = """chg AS (SELECT * FROM src
  WHERE last_updated_at > TIMESTAMP '2024-01-24 00:00:00' AND last_updated_at < TIMESTAMP '2024-01-26 00:00:00')"""
_BASE = """base AS (SELECT event_id, ts, user_id, event_type, value, props, ts AS last_updated_at
  FROM events WHERE ts < TIMESTAMP '2024-01-25 00:00:00')"""
_IMG = """img AS (SELECT * FROM chg UNION ALL
  SELECT * FROM base WHERE event_id NOT IN (SELECT event_id FROM chg))"""
CDC = f"WITH {_SRC},\n{_CHG},\n{_BASE},\n{_IMG}\n"
_CHG2 = """chg2 AS (SELECT * FROM src
  WHERE last_updated_at > TIMESTAMP '2024-02-09 00:00:00' AND last_updated_at < TIMESTAMP '2024-02-11 00:00:00')"""
CDC2 = f"WITH {_SRC},\n{_CHG},\n{_BASE},\n{_IMG},\n{_CHG2}\n"

_EV_WIN = "ts > TIMESTAMP '2024-01-14 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'"
_EV_WIN2 = "ts > TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00'"
_DAY = "CAST(year({c}) AS INT) AS year, CAST(month({c}) AS INT) AS month, CAST(day({c}) AS INT) AS day"

_COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n FROM {t}" for t in TESTDATA_TABLE_NAMES)

_ORACLES: dict[str, str] = {
    "source_scan": "SELECT * FROM events",
    "derive_partition_columns": f"SELECT o_orderkey, {_ymd('o_orderdate')} FROM orders",
    "partition_key_strings": """SELECT DISTINCT CAST(year(ts) AS VARCHAR) AS year, CAST(month(ts) AS VARCHAR) AS month,
        CAST(day(ts) AS VARCHAR) AS day FROM events""",
    "distinct_partitions": f"SELECT DISTINCT {_DAY.format(c='l_shipdate')} FROM lineitem",
    "partition_predicate": CDC + """SELECT DISTINCT concat('(year = ''', CAST(year(ts) AS VARCHAR), ''' AND month = ''',
        CAST(month(ts) AS VARCHAR), ''' AND day = ''', CAST(day(ts) AS VARCHAR), ''')') AS cond FROM chg""",
    "partition_path": CDC + """SELECT DISTINCT concat('/year=', CAST(year(ts) AS VARCHAR), '/month=',
        CAST(month(ts) AS VARCHAR), '/day=', CAST(day(ts) AS VARCHAR)) AS full_path FROM chg""",
    "preview": "SELECT * FROM events ORDER BY event_id LIMIT 20",
    "table_counts": _COUNTS,
    "change_window": f"SELECT * FROM events WHERE {_EV_WIN}",
    "change_window_bounds": """SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1998-01-14 00:00:00'
        AND o_orderdate < TIMESTAMP '1998-01-16 00:00:00'""",
    "has_changes": f"""SELECT '2024-01-15' AS as_of, EXISTS (SELECT 1 FROM events WHERE {_EV_WIN}) AS has_changes
        UNION ALL SELECT '2023-06-01', EXISTS (SELECT 1 FROM events WHERE ts > TIMESTAMP '2023-05-31 00:00:00'
        AND ts < TIMESTAMP '2023-06-02 00:00:00')""",
    "latest_per_key": f"""WITH {_SRC},
        u AS (SELECT * FROM src UNION ALL SELECT *, ts AS last_updated_at FROM events),
        r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY last_updated_at DESC, ts DESC,
              user_id DESC, event_type DESC, value DESC, props DESC) AS rn FROM u)
        SELECT event_id, ts, user_id, event_type, value, props, last_updated_at FROM r WHERE rn = 1""",
    "materialise": CDC + "SELECT * FROM chg",
    "change_stamp": """SELECT c_custkey, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders
        WHERE o_orderdate > TIMESTAMP '1998-01-12 00:00:00' AND o_orderdate < TIMESTAMP '1998-01-18 00:00:00')
        THEN TIMESTAMP '2024-01-15 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS last_updated_at
        FROM customer""",
    "column_defaults": "SELECT c_custkey, COALESCE(NULLIF(c_mktsegment, 'BUILDING'), 'OPEN') AS status FROM customer",
    "touched_partitions": CDC + f"""SELECT DISTINCT {_DAY.format(c='base.ts')}
        FROM base JOIN chg ON base.event_id = chg.event_id""",
    "unchanged_rows": CDC + "SELECT * FROM base WHERE event_id NOT IN (SELECT event_id FROM chg)",
    "merge_image": CDC + f"SELECT *, {_ymd('ts')} FROM img",
    "align_columns": CDC + """SELECT event_id, ts, user_id, event_type, value, CAST(NULL AS VARCHAR) AS props,
        last_updated_at FROM chg""",
    "refresh_table": f"SELECT *, {_ymd('ts')} FROM events",
    "lake_replace": """SELECT *, CAST(o_orderdate AS DATE) AS partition_date, CAST(year(o_orderdate) AS INT) AS year,
        CAST(month(o_orderdate) AS INT) AS month FROM orders""",
    "lake_append": f"SELECT *, {_ymd('ts')} FROM events UNION ALL SELECT *, {_ymd('ts')} FROM events",
    "lake_replace_where": f"""SELECT * EXCLUDE (value), value, {_ymd('ts')} FROM events
        WHERE NOT (year(ts) = 2024 AND month(ts) = 1 AND day(ts) IN (3, 4))
        UNION ALL SELECT * EXCLUDE (value), value * 2 AS value, {_ymd('ts')} FROM events
        WHERE year(ts) = 2024 AND month(ts) = 1 AND day(ts) IN (3, 4) AND event_type = 'purchase'""",
    "lake_scan": f"SELECT *, {_ymd('ts')} FROM events",
    "lake_partition_scan": f"SELECT *, {_ymd('ts')} FROM events WHERE year(ts) = 2024 AND month(ts) = 1 AND day(ts) IN (3, 4)",
    "partition_inventory": f"SELECT {_DAY.format(c='ts')}, COUNT(*) AS n FROM events GROUP BY ALL",
    "null_partition": """WITH e AS (SELECT CASE WHEN event_type <> 'error' THEN ts END AS created_at FROM events)
        SELECT CAST(year(created_at) AS INT) AS year, CAST(month(created_at) AS INT) AS month,
        CAST(day(created_at) AS INT) AS day, COUNT(*) AS n FROM e GROUP BY ALL""",
    "insert_table": f"""SELECT *, {_ymd('ts')} FROM events WHERE {_EV_WIN}
        UNION ALL SELECT *, {_ymd('ts')} FROM events WHERE {_EV_WIN2}""",
    "insert_dedupe": f"""SELECT *, {_ymd('ts')} FROM events
        WHERE ts > TIMESTAMP '2024-01-14 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00'""",
    "update_table": CDC + f"SELECT *, {_ymd('ts')} FROM img",
    "update_moving_rows": CDC + f"SELECT *, {_ymd('last_updated_at')} FROM img",
    "update_moving_inventory": CDC + f"SELECT {_DAY.format(c='last_updated_at')}, COUNT(*) AS n FROM img GROUP BY ALL",
    "update_rerun": CDC + f"SELECT *, {_ymd('last_updated_at')} FROM img",
    "refresh_full": _content_sql(TESTDATA_TABLE_NAMES),
    "update_full": f"""WITH {_SRC},
{_CHG},
{_BASE},
{_IMG},
osrc AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderdate,
         CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 30 DAY ELSE o_orderdate END AS last_updated_at FROM orders),
ochg AS (SELECT * FROM osrc WHERE last_updated_at > TIMESTAMP '1997-12-31 00:00:00' AND last_updated_at < TIMESTAMP '1998-01-30 00:00:00'),
oimg AS (SELECT * FROM ochg UNION ALL SELECT o_orderkey, o_totalprice, o_orderdate, o_orderdate FROM orders
         WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ochg))
SELECT 'events' AS table_name, event_id AS id, value, last_updated_at, CAST(ts AS DATE) AS partition_date FROM img UNION ALL
SELECT 'orders', o_orderkey, o_totalprice, last_updated_at, CAST(o_orderdate AS DATE) FROM oimg""",
    "update_unpartitioned": CDC + "SELECT * FROM img",
    "update_corrected_created": CDC + f"""SELECT *, {_ymd('ts')} FROM (
        SELECT * REPLACE (CASE WHEN event_type = 'purchase' THEN ts + INTERVAL 2 DAY ELSE ts END AS ts) FROM chg
        UNION ALL SELECT * FROM base WHERE event_id NOT IN (SELECT event_id FROM chg))""",
    "update_null_partition": CDC + f"""SELECT *, {_ymd('ts')} FROM (
        SELECT * REPLACE (CASE WHEN event_type <> 'purchase' THEN ts END AS ts) FROM chg
        UNION ALL SELECT * FROM base WHERE event_id NOT IN (SELECT event_id FROM chg))""",
    "update_latest_only": CDC + f"SELECT *, {_ymd('ts')} FROM img",
    "update_stale_rows": f"""WITH {_SRC},
{_CHG},
{_BASE},
eff AS (SELECT * REPLACE (CASE WHEN event_id % 2 = 0 THEN ts - INTERVAL 1 DAY ELSE last_updated_at END AS last_updated_at)
  FROM chg WHERE NOT (event_id % 2 = 0 AND event_id IN (SELECT event_id FROM base)))
        SELECT *, {_ymd('ts')} FROM (
        SELECT * FROM eff UNION ALL SELECT * FROM base WHERE event_id NOT IN (SELECT event_id FROM eff))""",
    "stream_late_file": CDC2 + f"""SELECT *, {_ymd('ts')} FROM chg2 UNION ALL
        SELECT *, {_ymd('ts')} FROM img WHERE event_id NOT IN (SELECT event_id FROM chg2)""",
    "dq_foreign_key_parts": """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l
        WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = l.l_partkey)""",
    "update_insert_only": CDC2 + f"""SELECT *, {_ymd('ts')} FROM chg2 UNION ALL
        SELECT *, {_ymd('ts')} FROM base WHERE event_id NOT IN (SELECT event_id FROM chg2)""",
    "refresh_changed_partitions": f"""SELECT *, {_ymd('ts')} FROM (SELECT *, CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10'
        THEN TIMESTAMP '2024-01-25 06:00:00' ELSE ts END AS last_updated_at FROM events)""",
    "refresh_changed_days": f"""SELECT {_DAY.format(c='ts')}, COUNT(*) AS n,
        CAST(ts AS DATE) = DATE '2024-01-10' OR CAST(ts AS DATE) >= DATE '2024-01-25' AS rewritten FROM events GROUP BY ALL""",
    "update_key_in_two_days": CDC + f"""SELECT *, {_ymd('ts')} FROM (SELECT * FROM chg UNION ALL SELECT * FROM (
        SELECT * FROM base UNION ALL SELECT * REPLACE (ts + INTERVAL 3 DAY AS ts) FROM base WHERE event_type = 'purchase'
        AND ts >= TIMESTAMP '2024-01-13 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00')
        WHERE event_id NOT IN (SELECT event_id FROM chg))""",
    "insert_rerun": f"""SELECT *, {_ymd('ts')} FROM events WHERE {_EV_WIN}
        UNION ALL SELECT *, {_ymd('ts')} FROM events WHERE {_EV_WIN2}""",
    "insert_from_mark": f"SELECT *, {_ymd('ts')} FROM events",
    "partition_ranges": """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'P'),
        r AS (SELECT d, d - CAST(row_number() OVER (ORDER BY d) AS INT) AS island FROM d)
        SELECT MIN(d) AS first_day, MAX(d) AS last_day, COUNT(*) AS days FROM r GROUP BY island""",
    "dq_unique_changed": """SELECT event_id, COUNT(*) AS n FROM (SELECT event_id FROM events UNION ALL
        SELECT event_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10') GROUP BY event_id HAVING COUNT(*) > 1""",
    "dq_foreign_key_changed": """SELECT o_custkey, COUNT(*) AS n_refs FROM (SELECT o_custkey FROM orders UNION ALL
        SELECT -o_custkey FROM orders WHERE year(o_orderdate) = 1996 AND month(o_orderdate) = 2)
        WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 7) GROUP BY o_custkey""",
    "job_entry": """SELECT 'events' AS table_name, event_id AS id, CAST(ts AS DATE) AS partition_date FROM events
        WHERE ts > TIMESTAMP '2024-01-12 00:00:00' AND ts < TIMESTAMP '2024-01-18 00:00:00'
        UNION ALL SELECT 'orders', o_orderkey, CAST(o_orderdate AS DATE) FROM orders""",
    "compact_table": f"""SELECT {_DAY.format(c='ts')}, COUNT(*) AS n, CAST(SUM(value) AS DECIMAL(18,2)) AS total,
        CAST(1 AS BIGINT) AS files FROM events GROUP BY ALL""",
    "write_clustered": """SELECT *, CAST(o_orderdate AS DATE) AS partition_date, CAST(year(o_orderdate) AS INT) AS year FROM orders""",
    "evolve_columns": f"""SELECT event_id, ts, CAST(user_id AS BIGINT) AS user_id, event_type, value,
        CASE WHEN ts >= TIMESTAMP '2024-01-25 00:00:00' THEN props END AS props, {_ymd('ts')} FROM events""",
    "update_no_change": CDC + f"SELECT *, {_ymd('ts')} FROM base",
    "stream_update": CDC2 + f"""SELECT *, {_ymd('ts')} FROM chg2 UNION ALL
        SELECT *, {_ymd('ts')} FROM img WHERE event_id NOT IN (SELECT event_id FROM chg2)""",
    "stream_insert": f"""SELECT *, {_ymd('ts')} FROM events
        WHERE ts > TIMESTAMP '2024-01-14 00:00:00' AND ts < TIMESTAMP '2024-01-17 00:00:00'""",
    "insert_full": _content_sql(("lineitem", "orders"), {
        t: f"{c} > TIMESTAMP '1998-01-14 00:00:00' AND {c} < TIMESTAMP '1998-01-16 00:00:00'" for t, c in (("lineitem", "l_shipdate"), ("orders", "o_orderdate"))}),
    "scan_one_or_many": _COUNTS,
    "partition_prune": CDC + f"""SELECT *, {_ymd('ts')} FROM events
        WHERE CAST(ts AS DATE) IN (SELECT DISTINCT CAST(ts AS DATE) FROM chg)""",
    "prepare_and_save": """SELECT *, CAST(l_shipdate AS DATE) AS partition_date, CAST(year(l_shipdate) AS INT) AS year,
        CAST(month(l_shipdate) AS INT) AS month FROM lineitem""",
    "dq_not_null": """SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        WHERE l.quality IS NULL OR l.toxic IS NULL""",
    "dq_primary_key": """SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""",
    "dq_unique": "SELECT p_name, COUNT(*) AS n FROM part WHERE p_name IS NOT NULL GROUP BY p_name HAVING COUNT(*) > 1",
    "dq_foreign_key": """SELECT doc_id, lang, source FROM documents d
        WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "dq_foreign_key_orders": """SELECT o_orderkey, o_custkey FROM orders o
        WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""",
    "dq_allowed_values": """SELECT event_id, event_type FROM events
        WHERE event_type NOT IN ('view', 'click', 'purchase', 'signup')""",
    "dq_max_length": "SELECT doc_id, source FROM documents WHERE length(source) > 4",
    "dq_decimal_fit": """WITH li AS (SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS charge
        FROM lineitem)
        SELECT * FROM li WHERE TRY_CAST(charge AS DECIMAL(15, 2)) IS NULL
        OR TRY_CAST(charge AS DECIMAL(15, 2)) <> charge""",
}


_ORACLES["dq_summary"] = _dq_summary_sql(LINEITEM_RULES)
_ORACLES["update_orders_month"] = """WITH src AS (
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
         o_orderdate, o_orderpriority,
         CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 30 DAY ELSE o_orderdate END AS last_updated_at
  FROM orders),
chg AS (SELECT * FROM src WHERE last_updated_at > TIMESTAMP '1997-12-31 00:00:00'
                            AND last_updated_at < TIMESTAMP '1998-01-30 00:00:00'),
base AS (SELECT *, o_orderdate AS last_updated_at FROM orders),
img AS (SELECT * FROM chg UNION ALL SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM chg))
SELECT *, CAST(o_orderdate AS DATE) AS partition_date, CAST(year(o_orderdate) AS INT) AS year,
       CAST(month(o_orderdate) AS INT) AS month FROM img"""


def oracle_sql() -> dict[str, str]:
    return {**_ORACLES, **_LLM_ORACLES}
