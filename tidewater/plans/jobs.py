"""User-level jobs: refresh, insert, update (copy-on-write upsert) and run_action.

Spark actions per job: refresh 1 write (plus file listings to drop partitions the new
content no longer has), insert 1 write (with key dedupe the rows are staged first), update:
stage the change set once, ONE aggregate for row count + key size bound + partition set +
oldest change stamp, one one-column aggregate for the newest-wins test (newest affected lake
stamp), the lookup of the partitions that hold changed keys, then the write. The source is
queried once per job in every case.
"""

from __future__ import annotations

import json
import logging
import os
import time
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater import fs
from tidewater.functions.partitions import dates_to_partitions, derive_partition_columns, partition_dir
from tidewater.functions.ranges import range_filter, time_ranges
from tidewater.functions.windows import as_date, window_partition_dates
from tidewater.operators.changes import any_null, change_window, latest_per_key
from tidewater.operators.filefacts import combined, file_digests, files_below, files_that_may_hold, key_filters, partition_digests
from tidewater.operators.inventory import collect_partitions
from tidewater.operators.merge import (
    align_columns,
    drop_stale_changes,
    may_hold_stale_changes,
    merge_image,
    touched_partitions,
    unchanged_rows,
)
from tidewater.operators.sizing import change_profile, may_broadcast
from tidewater.operators.staging import materialise
from tidewater.plans.context import EngineContext
from tidewater.plans.evolution import evolved, log_schema, logged_schema
from tidewater.plans.locking import TableLocked
from tidewater.plans.specs import TableSpec, action_parameters
from tidewater.sinks.batches import append_once, batch_files, recover_batches
from tidewater.sinks.lake import drop_partitions, lake_append, lake_replace, lake_replace_where, write_lake
from tidewater.sources.catalog import list_source_tables
from tidewater.sources.lake import lake_partition_scan, lake_scan


log = logging.getLogger("tidewater")


@dataclass
class JobResult:
    table: str
    action: str
    status: str  # "written" | "no_changes" | "skipped"
    change_rows: int | None = None
    affected_partitions: list = field(default_factory=list)
    dropped_partitions: list = field(default_factory=list)
    note: str = ""


class ActionFailed(RuntimeError):
    """Some tables of a ``full`` run failed; ``results`` holds every table's outcome (tables
    that succeeded are written and stay written)."""

    def __init__(self, message: str, results: list[JobResult]):
        super().__init__(message)
        self.results = results


def prepare_and_save(ctx: EngineContext, df: DataFrame, spec: TableSpec, write: str) -> None:
    """Add partition columns from the spec's partitioning column and write."""
    path = ctx.table_path(spec.name)
    cols = spec.partition_cols
    if spec.partition_by:
        df = derive_partition_columns(df, spec.partition_by, spec.grain)
    ctx.check_lock(spec.name)
    kw = ctx.write_options(spec.name, full_copy_unpartitioned=(write == "overwrite" and not cols))
    if write == "overwrite":
        lake_replace(df, path, cols, **kw)
    elif write == "append":
        lake_append(df, path, cols, **kw)
    else:
        raise ValueError(f"unknown write {write!r}")


def _layout(spark: SparkSession, path: str, cols) -> str:
    """"missing" (no data), "same" (files sit under exactly ``cols`` directory levels) or
    "different" — checked on one data file, so it costs one listing call."""
    first = fs.first_data_file(spark, path)
    if first is None:
        return "missing"
    rel = first[len(fs.qualify(spark, path)):].strip("/").split("/")[:-1]
    return "same" if [seg.split("=", 1)[0] for seg in rel] == list(cols) else "different"


def _same_layout(spark: SparkSession, path: str, cols) -> bool:
    return _layout(spark, path, cols) == "same"


def _check_layout(spark: SparkSession, name: str, path: str, cols) -> bool:
    """True when the lake table exists with the spec's partitioning; False when it does not
    exist; an error when it is laid out differently (partitioning changed: refresh first)."""
    state = _layout(spark, path, cols)
    if state == "different":
        raise ValueError(f"lake table {name!r} at {path} is not partitioned by {list(cols)}; "
                         "refresh it before inserting or updating")
    return state == "same"


_STAGING_PREFIX = ".tidewater-refresh-"
_SWAP = "_tidewater_swap"  # hidden from readers
_MOVES_AT_ONCE = 16


def _each(names, do) -> None:
    """``do`` for every name, several at once; the first failure is raised after all ended."""
    with ThreadPoolExecutor(max_workers=_MOVES_AT_ONCE) as pool:
        for future in [pool.submit(do, n) for n in names]:
            future.result()


def _move(spark: SparkSession, src: str, dst: str) -> None:
    # Hadoop's rename tells several failures by returning false
    if not fs.rename(spark, src, dst):
        raise OSError(f"could not move {src} to {dst}")


def _delete(spark: SparkSession, path: str) -> None:
    if not fs.delete(spark, path) and fs.exists(spark, path):
        raise OSError(f"could not delete {path}")


def _in_folders(spark: SparkSession, path: str, names) -> set[str]:
    """The files, relative to ``path``, in the folders of ``names``."""
    root = fs.qualify(spark, path)
    folders = {f"{path}/{n.rsplit('/', 1)[0]}" if "/" in n else path for n in names}
    return {f[len(root) + 1:] for f in fs.data_files(spark, *sorted(folders))}


def _finish_swap(spark: SparkSession, path: str, plan: dict) -> None:
    """Carries a written swap plan out from wherever it stopped: moves what is still staged,
    and deletes the old files only when every new one is in place."""
    staging = f"{path}/{plan['staging']}"
    waiting = _in_folders(spark, staging, plan["new"])
    if waiting:
        for folder in {n.rsplit("/", 1)[0] for n in plan["new"] if "/" in n}:
            fs.make_dirs(spark, f"{path}/{folder}")
    _each([n for n in plan["new"] if n in waiting], lambda n: _move(spark, f"{staging}/{n}", f"{path}/{n}"))
    present = _in_folders(spark, path, [*plan["new"], *plan["old"]])
    lost = [n for n in plan["new"] if n not in present]
    if lost:
        raise OSError(f"{len(lost)} new files of {path} are missing, e.g. {lost[0]}; the old files were not touched")
    _each([n for n in plan["old"] if n in present], lambda n: _delete(spark, f"{path}/{n}"))
    _delete(spark, staging)
    _delete(spark, f"{path}/{_SWAP}")


def finish_swap(spark: SparkSession, path: str, plan: dict) -> None:
    _finish_swap(spark, path, plan)


def write_swap_plan(spark: SparkSession, path: str, plan: str) -> None:
    """From here on the swap is finished by whoever comes next."""
    part = f"{path}/{_SWAP}.{os.urandom(4).hex()}"
    fs.write_text(spark, part, plan)
    _move(spark, part, f"{path}/{_SWAP}")


def recover_swap(spark: SparkSession, path: str) -> bool:
    """Finishes a swap that a failed job left half done, and removes staging folders of swaps
    that never began. Every job calls it first, under the table's lock."""
    entries = fs.list_entries(spark, path)
    if any(name == _SWAP for name, _ in entries):
        plan = fs.read_text(spark, f"{path}/{_SWAP}")
        log.warning("finishing the interrupted swap of %s", path)
        _finish_swap(spark, path, json.loads(plan))
        return True
    for child, is_dir in entries:
        if child.startswith((_STAGING_PREFIX, f"{_SWAP}.")):
            fs.delete(spark, f"{path}/{child}")
    return False


def _swap_in_unpartitioned(ctx: EngineContext, name: str, path: str, df: DataFrame, full_copy: bool) -> int:
    """Replace an existing unpartitioned table without an empty moment: write ``df`` into a
    hidden folder inside the table (readers skip hidden folders), move the new files in next
    to the old ones (Spark's file names carry the job id, so they never collide), then delete
    the old ones. ``df`` may read the table itself: it is written in full before anything old
    is touched.

    A plan with all new and old names is written before the first move. A failed write leaves
    the old table as it was; a move that fails is undone with those before it; a job that died
    in between is finished from the plan by the next job on the table (``recover_swap``). Until
    then readers may see old and new rows together. Returns the old file count."""
    spark = ctx.spark
    old = [c for c, is_dir in fs.list_entries(spark, path) if not is_dir and not c.startswith(("_", "."))]
    folder = f"{_STAGING_PREFIX}{os.urandom(6).hex()}"
    staging = f"{path}/{folder}"
    write_lake(df, staging, [], "overwrite", **ctx.write_options(name, full_copy_unpartitioned=full_copy))
    new = [c for c, is_dir in fs.list_entries(spark, staging) if not is_dir and not c.startswith(("_", "."))]
    ctx.check_lock(name)
    plan = {"staging": folder, "new": new, "old": old}
    write_swap_plan(spark, path, json.dumps(plan))
    try:
        _each(new, lambda n: _move(spark, f"{staging}/{n}", f"{path}/{n}"))
    except Exception:
        moved = [n for n in new if not fs.exists(spark, f"{staging}/{n}")]
        _each(moved, lambda n: _move(spark, f"{path}/{n}", f"{staging}/{n}"))
        _delete(spark, f"{path}/{_SWAP}")
        raise
    _finish_swap(spark, path, plan)
    return len(old)


def _partition_of(uri: str, depth: int) -> str:
    return "/".join(uri.rsplit("/", 1)[0].split("/")[-depth:])


def _refresh_unpartitioned(ctx: EngineContext, name: str, path: str) -> JobResult:
    replaced = _swap_in_unpartitioned(ctx, name, path, ctx.source.table(name), full_copy=True)
    log.info("refresh %s: replaced %d files of %s", name, replaced, path)
    return JobResult(name, "refresh", "written")


def _refresh_table(ctx: EngineContext, name: str, keep_old_until_commit: bool = True) -> JobResult:
    """Replace the lake table with the whole source table (one pass, one write action).

    For a partitioned table that already exists the new content is written with dynamic
    partition overwrite: until the job commits, readers and a failed or killed job see the
    old table intact (a static overwrite would delete it before writing). Partitions the new
    content does not have are those that hold files listed before the write only (file names
    carry the id of the job that wrote them), and are deleted. An existing unpartitioned table
    is written to a hidden folder first and swapped in (``_swap_in_unpartitioned``).
    ``keep_old_until_commit=False``, a new table, and a table whose partition layout changed
    (e.g. day to month grain) use a plain static overwrite.
    """
    spec = ctx.spec(name)
    spark = ctx.spark
    path = ctx.table_path(name)
    cols = spec.partition_cols
    if keep_old_until_commit and not cols and _same_layout(spark, path, cols):
        return _refresh_unpartitioned(ctx, name, path)
    if not (keep_old_until_commit and cols and _same_layout(spark, path, cols)):
        prepare_and_save(ctx, ctx.source.table(name), spec, "overwrite")
        log.info("refresh %s: replaced %s", name, path)
        return JobResult(name, "refresh", "written")
    before = set(fs.data_files(spark, path))
    df = derive_partition_columns(ctx.source.table(name), spec.partition_by, spec.grain)
    ctx.check_lock(name)
    lake_replace_where(df, path, cols, **ctx.write_options(name))
    after = fs.data_files(spark, path)
    fresh = {_partition_of(f, len(cols)) for f in after if f not in before}
    stale = sorted({_partition_of(f, len(cols)) for f in after} - fresh)
    ctx.check_lock(name)
    _each(stale, lambda d: _delete(spark, f"{path}/{d}"))
    _drop_empty_parents(spark, path, stale)
    log.info("refresh %s: rewrote %s, dropped %d partitions no longer in the source", name, path, len(stale))
    return JobResult(name, "refresh", "written", dropped_partitions=stale)


def _refresh_changed_partitions(ctx: EngineContext, name: str) -> JobResult:
    """Makes the lake table equal to the source by rewriting only the partitions whose content
    differs.

    One pass over the source gives each partition's digest; the lake's come from its files' stored
    digests (files without one are read). Partitions whose digests differ are read from the source
    again, by ranges of their days where the partitioning column is a date or timestamp, and
    overwritten; those the source has no longer are deleted. A table that does not exist yet, is
    not partitioned, or has other columns, types or partitioning than the source is refreshed as a
    whole. Should the source move between the two reads, the table holds what the second one
    saw, and the next run sees the difference.
    """
    spec, spark, path = ctx.spec(name), ctx.spark, ctx.table_path(name)
    cols = list(spec.partition_cols)
    if not cols or not _same_layout(spark, path, cols):
        return _refresh_table(ctx, name)
    df = derive_partition_columns(ctx.source.table(name), spec.partition_by, spec.grain)
    schema = lake_schema(spark, path, cols)
    kinds = lambda s: {f.name: f.dataType.simpleString() for f in s.fields}
    if kinds(schema) != kinds(df.schema):
        log.info("refresh %s: the source's columns are not the lake's; refreshing the whole table", name)
        return _refresh_table(ctx, name)
    columns = [c for c in df.columns if c not in cols]
    files = files_below(spark, path)
    by_file = file_digests(spark, ctx.lake_root, name, path, files, schema, columns)
    folder = F.regexp_replace("file", "/[^/]*$", "")
    lake = {r["folder"]: tuple(r)[1:] for r in by_file.groupBy(folder.alias("folder")).agg(*combined()).collect() if r["n"]}
    held = {partition_dir("", tuple(r)[:len(cols)], cols).strip("/"): (tuple(r)[:len(cols)], tuple(r)[len(cols):])
            for r in partition_digests(df, cols, columns).collect()}
    differ = [key for d, (key, digest) in held.items() if lake.get(d) != digest]
    gone = sorted({f.rsplit("/", 1)[0] for f in files} - set(held))
    if differ:
        rows = df.where(time_ranges(df, spec.partition_by, differ, spec.grain)).where(range_filter(differ, cols))
        ctx.check_lock(name)
        lake_replace_where(rows, path, cols, **ctx.write_options(name))
        old = set(files)
        fresh = {f.rsplit("/", 1)[0] for f in files_below(spark, path) if f not in old}
        gone += sorted({partition_dir("", key, cols).strip("/") for key in differ} - fresh)
    present = {f.rsplit("/", 1)[0] for f in files}
    gone = [d for d in gone if d in present]
    if gone:
        ctx.check_lock(name)
        _each(gone, lambda d: _delete(spark, f"{path}/{d}"))
        _drop_empty_parents(spark, path, gone)
    log.info("refresh %s: rewrote %d of %d partitions, dropped %d", name, len(differ), len(held), len(gone))
    return JobResult(name, "refresh", "written" if differ or gone else "no_changes", None, differ, gone)


def _drop_empty_parents(spark: SparkSession, path: str, partitions) -> None:
    """Deletes the folders above deleted partitions that hold nothing any more."""
    parents = {p.rsplit("/", 1)[0] for p in partitions if "/" in p}
    while parents:
        empty = [p for p in sorted(parents) if not fs.list_children(spark, f"{path}/{p}")]
        for p in empty:
            fs.delete(spark, f"{path}/{p}")
        parents = {p.rsplit("/", 1)[0] for p in empty if "/" in p}


def lake_schema(spark: SparkSession, path: str, cols) -> T.StructType:
    """Schema of a lake table from one data file's footer plus int partition columns
    (no listing of the whole table)."""
    first = fs.first_data_file(spark, path)
    if first is None:
        raise FileNotFoundError(f"no data files under {path}")
    data = spark.read.parquet(first).schema
    extra = [T.StructField(c, T.IntegerType(), True) for c in cols if c not in data.fieldNames()]
    return T.StructType(data.fields + extra)


def insert_table(ctx: EngineContext, name: str, as_of=None, days: int = 1,
                 dedupe_on_key: bool = False, once: bool = False) -> JobResult:
    """Append the rows created inside the window (see ``append_changes``). With ``once``, the default
    of ``run_action`` and the command line, the window is a batch: run again, it adds nothing. (Rows
    that come into a window after its run are for the next window, for ``dedupe_on_key``, or for
    ``insert_new_rows``.)"""
    spec = ctx.spec(name)
    if not spec.created_column:
        raise ValueError(f"table {name!r} has no created column; insert needs one")
    as_of = as_date(as_of)
    source = ctx.source.table(name)
    _require_columns(source, [spec.created_column] + list(spec.keys if dedupe_on_key else ()), name, "created/key")
    window = change_window(source, spec.created_column, as_of, days)
    parts = None
    if spec.partition_by == spec.created_column and spec.stable_partitions:
        parts = dates_to_partitions(window_partition_dates(as_of, days), spec.grain)
    # a deduped insert may be repeated as it is, and then finds rows that came later
    batch = f"insert-{as_of.isoformat()}-{days}" if once and not dedupe_on_key else None
    return append_changes(ctx, name, window, dedupe_on_key, lookup_partitions=parts, batch=batch)


def _append_changes(ctx: EngineContext, name: str, rows: DataFrame, dedupe_on_key: bool = False,
                   lookup_partitions: list | None = None, batch: str | None = None) -> JobResult:
    """Append rows to the lake table in one pass (one Spark action).

    With ``batch`` the rows are added once under that id, whatever stops or repeats the job (see
    ``sinks.batches``); if they are there already nothing is read or written.

    With ``dedupe_on_key`` the rows are staged once, one row per key is kept (the newest by the
    change column, or the created one) and rows whose key is already in the lake are left out,
    which makes overlapping or repeated windows idempotent. Rows with a NULL key column are
    appended as they are: they are never taken for copies of each other.
    ``lookup_partitions`` limits that lookup to the partitions the rows can live in; when
    it is not given and the spec promises stable partitions, it is taken from the rows
    themselves (one small aggregate); otherwise the whole lake's keys are read.
    Rows appended to an existing table take its schema; a column missing from them or a type
    that doesn't fit is an error before anything is written.
    """
    spec = ctx.spec(name)
    spark = ctx.spark
    path = ctx.table_path(name)
    cols = spec.partition_cols
    if batch is not None and batch_files(spark, ctx.lake_root, name, batch) is not None:
        log.info("insert %s: batch %s is in the table already", name, batch)
        return JobResult(name, "insert", "no_changes", note=f"batch {batch} was added before")
    if spec.partition_by:
        rows = derive_partition_columns(rows, spec.partition_by, spec.grain)
    exists = _check_layout(spark, name, path, cols)
    if exists:
        rows = align_columns(rows, _target_schema(ctx, spec, rows.schema))
    staged = None
    if dedupe_on_key and spec.keys:
        stamp = next((c for c in (spec.change_column, spec.created_column) if c and c in rows.columns), None)
        staged = materialise(latest_per_key(rows, spec.keys, stamp), label=f"{name}-rows")
        rows = staged.df
    try:
        if staged and exists:
            if lookup_partitions is None and cols and spec.stable_partitions:
                lookup_partitions = collect_partitions(rows, cols)
            if lookup_partitions is not None:
                existing = lake_partition_scan(spark, path, lookup_partitions, cols)
            else:
                existing = lake_scan(spark, path)
            if existing is not None:
                rows = unchanged_rows(rows, existing.select(*spec.keys), spec.keys)
        if batch is not None:
            append_once(rows, path, cols, ctx.lake_root, name, batch, lambda: ctx.check_lock(name), **ctx.write_options(name))
        else:
            ctx.check_lock(name)
            lake_append(rows, path, cols, **ctx.write_options(name))
    finally:
        if staged:
            staged.release()
    log.info("insert %s: appended to %s (dedupe_on_key=%s)", name, path, dedupe_on_key)
    return JobResult(name, "insert", "written")


def _target_schema(ctx: EngineContext, spec: TableSpec, rows: T.StructType) -> T.StructType:
    """The schema that rows are written with: the lake's, or for a table that evolves one that
    holds both, which is logged first."""
    path, cols = ctx.table_path(spec.name), spec.partition_cols
    held = lake_schema(ctx.spark, path, cols)
    if not spec.evolve:
        return held
    held = logged_schema(ctx, spec.name) or held
    target = evolved(held, rows, cols)
    if target != held:
        ctx.check_lock(spec.name)
        log_schema(ctx, spec.name, target)
    return target


def _require_columns(df: DataFrame, columns, table: str, role: str) -> None:
    missing = [c for c in columns if c and c not in df.columns]
    if missing:
        raise ValueError(f"table {table!r}: {role} column(s) {missing} not in the source "
                         f"(columns: {df.columns})")


def _unique(seq):
    return list(dict.fromkeys(seq))


def update_table(ctx: EngineContext, name: str, as_of=None, days: int = 1,
                 latest_only: bool = False, newest_wins: bool = True) -> JobResult:
    """Copy-on-write upsert of the rows changed inside the window (see ``upsert_changes``)."""
    spec = ctx.spec(name)
    if not spec.change_column:
        raise ValueError(f"table {name!r} has no change column; update needs one")
    source = ctx.source.table(name)
    _require_columns(source, [spec.change_column, *spec.keys, spec.partition_by], name, "change/key/partition")
    raw = change_window(source, spec.change_column, as_date(as_of), days)
    return upsert_changes(ctx, name, raw, latest_only=latest_only, newest_wins=newest_wins)


def _upsert_changes(ctx: EngineContext, name: str, changes: DataFrame, latest_only: bool = False,
                   stage: bool = True, newest_wins: bool = True) -> JobResult:
    """Copy-on-write upsert of a change set into the lake table ``name``.

    1. stage the change set once in the shared folder (one source query);
    2. affected partitions = where the changed keys live now ∪ where they go. All keys are looked
       up in all other partitions, unless the spec promises stable partitions;
    3. image = affected rows without the changed keys ∪ the change rows;
    4. dynamic overwrite of exactly those partitions; partitions left empty are deleted.
    Afterwards every key has exactly one row (one per change row with ``latest_only``
    off and duplicate keys in the change set). Re-running with the same change set gives
    the same lake, so a retried batch is harmless. A change row with a NULL key column is an
    error: no later run could tell that it is there already. So are a lake column that the
    change set lacks and a type that doesn't fit. ``stage=False`` is for change sets that
    are already materialised.
    With ``newest_wins`` (and a change column) a change row older than the lake's row for
    its key is ignored, so replaying an old window or an out-of-order batch after newer ones
    cannot bring back old versions.
    """
    spec = ctx.spec(name)
    if not spec.keys:
        raise ValueError(f"table {name!r} has no key columns; update needs them")
    spark = ctx.spark
    keys = list(spec.keys)
    path = ctx.table_path(name)
    cols = list(spec.partition_cols)
    kw = ctx.write_options(name)

    raw = changes
    if latest_only:
        raw = latest_per_key(raw, keys, spec.change_column)
    if spec.partition_by:
        raw = derive_partition_columns(raw, spec.partition_by, spec.grain)
    staged = materialise(raw, label=f"{name}-changes") if stage else None
    try:
        changes = staged.df if staged else raw
        stamp = spec.change_column if newest_wins and spec.change_column in changes.columns else None
        if stamp:
            n, key_bytes, new_parts, oldest = change_profile(changes, keys + [stamp], cols, oldest_of=stamp)
        else:
            n, key_bytes, new_parts = change_profile(changes, keys, cols)
            oldest = None
        if n == 0:
            log.info("update %s: no changes", name)
            return JobResult(name, "update", "no_changes", 0)
        if any(changes.schema[k].nullable for k in keys) and not changes.where(any_null(keys)).isEmpty():
            raise ValueError(f"table {name!r}: change rows with a NULL in key columns {keys}")
        bcast = may_broadcast(key_bytes, ctx.broadcast_limit)
        log.info("update %s: %d change rows, key bound %d bytes, broadcast keys: %s", name, n, key_bytes, bcast)

        if not _check_layout(spark, name, path, cols):
            ctx.check_lock(name)
            write_lake(changes, path, cols, "append", **kw)
            return JobResult(name, "update", "written", n, note="lake was empty")

        target = _target_schema(ctx, spec, changes.schema)
        changes = align_columns(changes, target)
        if not cols:
            # Unpartitioned table: the image is the whole table; it is written in full before
            # the old files are swapped out.
            lake = lake_scan(spark, path, target)
            if stamp and stamp in lake.columns and may_hold_stale_changes(changes, lake, stamp, oldest):
                changes = drop_stale_changes(changes, lake, keys, stamp, bcast)
            _swap_in_unpartitioned(ctx, name, path, merge_image(lake, changes, keys, bcast), full_copy=False)
            return JobResult(name, "update", "written", n)

        old_parts = [] if spec.stable_partitions else _partitions_of_keys(ctx, path, changes, spec, new_parts, bcast, target)
        affected = _unique(old_parts + new_parts)

        existing = lake_partition_scan(spark, path, affected, cols, target)
        if existing is None:
            ctx.check_lock(name)
            lake_replace_where(changes, path, cols, **kw)
            return JobResult(name, "update", "written", n, affected, note="insert only")

        if stamp and stamp in existing.columns and may_hold_stale_changes(changes, existing, stamp, oldest):
            changes = drop_stale_changes(changes, existing, keys, stamp, bcast)
        folders = {p: partition_dir(path, p, cols) for p in affected}
        before = set(fs.data_files(spark, *folders.values()))
        image = merge_image(existing, changes, keys, bcast)
        ctx.check_lock(name)
        lake_replace_where(image, path, cols, **kw)
        # Affected partitions that got no new file have no row in the image.
        fresh = {_partition_of(f, len(cols)) for f in fs.data_files(spark, *folders.values()) if f not in before}
        drop = [p for p, d in folders.items() if "/".join(d.split("/")[-len(cols):]) not in fresh and fs.exists(spark, d)]
        if drop:
            ctx.check_lock(name)
        drop_partitions(spark, path, drop, cols)
        log.info("update %s: rewrote %d partitions, dropped %d emptied", name, len(affected), len(drop))
        return JobResult(name, "update", "written", n, affected, drop)
    finally:
        if staged:
            staged.release()


def _partitions_of_keys(ctx: EngineContext, path, changes, spec, new_parts, bcast: bool, schema: T.StructType) -> list:
    """Partitions of the lake, besides ``new_parts``, that hold a key of the change set, looked up
    exactly: a key may stand in any partition, and in several (an insert without dedupe can put it
    there).

    In a lake of some size the files' key filters say first which files can hold a key; only
    the key columns of those are read. Keys new to the lake then open no data file, but for the
    filters' rare false hits."""
    spark, cols, keys = ctx.spark, list(spec.partition_cols), list(spec.keys)
    rewritten = {partition_dir("", p, cols).strip("/") for p in new_parts}
    files = [f for f in files_below(spark, path) if f.rsplit("/", 1)[0] not in rewritten]
    if not files:
        return []
    if bcast and ctx.key_filter_min_bytes <= 0 or bcast and fs.total_bytes(spark, path) >= ctx.key_filter_min_bytes:
        filters = key_filters(spark, ctx.lake_root, spec.name, path, files, schema, keys)
        hit = files_that_may_hold(filters, changes, keys)
        log.info("update %s: %d of %d files may hold a changed key", spec.name, len(hit), len(files))
        if not hit:
            return []
        lake = spark.read.option("basePath", path.rstrip("/")).schema(schema).parquet(*[f"{path}/{f}" for f in hit])
    else:
        lake = lake_scan(spark, path, schema).where(~range_filter(new_parts, cols))
    return collect_partitions(touched_partitions(lake, changes, keys, cols, bcast), cols)


def _recover(ctx: EngineContext, name: str) -> None:
    """What a job that died on the table left to do."""
    path = ctx.table_path(name)
    recover_swap(ctx.spark, path)
    recover_batches(ctx.spark, ctx.lake_root, name, path, lambda: ctx.check_lock(name))


def _log_refreshed(ctx: EngineContext, name: str) -> None:
    """After a refresh the log's newest schema is the new files'."""
    spec, path = ctx.spec(name), ctx.table_path(name)
    if spec.evolve and fs.has_data_files(ctx.spark, path):
        log_schema(ctx, name, lake_schema(ctx.spark, path, spec.partition_cols))


def refresh_table(ctx: EngineContext, name: str, keep_old_until_commit: bool = True, changed_only: bool = False) -> JobResult:
    """Replace the lake table with the whole source table (see ``_refresh_table``), or with
    ``changed_only`` only the partitions that differ (see ``_refresh_changed_partitions``); holds
    the table's writer lock while it runs."""
    with ctx.lock(name, "refresh"):
        _recover(ctx, name)
        result = _refresh_changed_partitions(ctx, name) if changed_only else _refresh_table(ctx, name, keep_old_until_commit)
        _log_refreshed(ctx, name)
        return result


def append_changes(ctx: EngineContext, name: str, rows: DataFrame, dedupe_on_key: bool = False,
                   lookup_partitions: list | None = None, batch: str | None = None) -> JobResult:
    """Append rows to the lake table (see ``_append_changes``) under the writer lock."""
    with ctx.lock(name, "insert"):
        _recover(ctx, name)
        return _append_changes(ctx, name, rows, dedupe_on_key, lookup_partitions, batch)


def upsert_changes(ctx: EngineContext, name: str, changes: DataFrame, latest_only: bool = False,
                   stage: bool = True, newest_wins: bool = True) -> JobResult:
    """Copy-on-write upsert of a change set (see ``_upsert_changes``) under the writer lock."""
    with ctx.lock(name, "update"):
        _recover(ctx, name)
        return _upsert_changes(ctx, name, changes, latest_only, stage, newest_wins)



def bookmark_path(ctx: EngineContext, action: str, name: str) -> str:
    return f"{ctx.lake_root}/_tidewater_bookmarks/{name.strip('/')}.{action}"


def last_success(ctx: EngineContext, action: str, name: str):
    """The ``as_of`` date of the last successful run of the action on the table, or ``None``."""
    text = fs.read_text(ctx.spark, bookmark_path(ctx, action, name))
    return as_date(text.strip()) if text else None


def run_table(ctx: EngineContext, action: str, name: str, as_of=None, days: int = 1,
              dedupe_on_key: bool = False, latest_only: bool = False,
              newest_wins: bool = True, since_last: bool = False, changed_only: bool = False,
              once: bool = True) -> JobResult:
    """One action on one table; a success moves the table's bookmark for the action to
    ``as_of`` (never back). ``since_last`` widens the window by the days since that bookmark,
    so runs that were missed are made up for; an insert then dedupes on keys."""
    as_of = as_date(as_of)
    last = last_success(ctx, action, name)
    if since_last and last is not None and last < as_of:
        days += (as_of - last).days
    if action == "refresh":
        result = refresh_table(ctx, name, changed_only=changed_only)
    elif action == "insert":
        result = insert_table(ctx, name, as_of, days, dedupe_on_key or since_last, once)
    elif action == "update":
        result = update_table(ctx, name, as_of, days, latest_only, newest_wins)
    else:
        action_parameters(action)  # raises for an unknown action
        raise AssertionError(action)
    _move_bookmark(ctx, action, name, as_of)
    return result


def _move_bookmark(ctx: EngineContext, action: str, name: str, as_of) -> None:
    """Read and written under a lock of its own, so no run can move it back."""
    for wait in (0.1, 0.5, 1, 2, 5, 10, None):
        try:
            with ctx.lock(f"{name}.{action}.bookmark", action):
                last = last_success(ctx, action, name)
                if last is None or last < as_of:
                    fs.write_text_at_once(ctx.spark, bookmark_path(ctx, action, name), as_of.isoformat())
            return
        except TableLocked:
            if wait is None:
                raise
            time.sleep(wait)


def _applicable(action: str, spec: TableSpec) -> str | None:
    if action == "insert" and not spec.created_column:
        return "no created column"
    if action == "update" and not (spec.keys and spec.change_column):
        return "no key or change column"
    return None


def _in_reference_order(ctx: EngineContext, action: str, names: list[str], one, at_once: int) -> list[JobResult]:
    """``one`` for every table, at most ``at_once`` at a time, the tables it references first. What
    references a table that failed, or was left out for that, is left out; a circle is an error."""
    graph = {n: [p for p in ctx.spec(n).references if p in names and p != n] for n in names}
    order, results = TopologicalSorter(graph), {}
    try:
        order.prepare()
    except CycleError as e:
        raise ValueError(f"tables reference each other in a circle: {' -> '.join(e.args[1])}") from None
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running: dict = {}
        while order.is_active():
            for n in order.get_ready():
                lost = [p for p in graph[n] if results[p].status == "failed" or results[p].note.startswith("left out")]
                if lost:
                    results[n] = JobResult(n, action, "skipped", note=f"left out: {', '.join(lost)} failed")
                    order.done(n)
                else:
                    running[pool.submit(one, n)] = n
            if running:
                for future in wait(running, return_when=FIRST_COMPLETED).done:
                    n = running.pop(future)
                    results[n] = future.result()
                    order.done(n)
    return [results[n] for n in names]


def run_action(ctx: EngineContext, action: str, mode: str, table: str | None = None,
               as_of=None, days: int = 1, dedupe_on_key: bool = False,
               latest_only: bool = False, max_concurrent_tables: int = 4,
               newest_wins: bool = True, since_last: bool = False, changed_only: bool = False,
               once: bool = True) -> list[JobResult]:
    """``partial``: one named table (error if none). ``full``: every source table; tables
    the action cannot apply to are reported as skipped. Tables come after those that they reference
    (``TableSpec.references``) and are left out when one of these failed; independent ones are
    submitted as concurrent Spark jobs (``max_concurrent_tables``). ``as_of`` is fixed once for all."""
    spec = action_parameters(action)
    if mode not in spec.modes:
        raise ValueError(f"mode {mode!r} is not one of {spec.modes} for {action!r}")
    as_of = as_date(as_of)
    if mode == "partial":
        if not table:
            raise ValueError("partial mode needs a table name")
        reason = _applicable(action, ctx.spec(table))
        if reason:
            raise ValueError(f"cannot {action} {table!r}: {reason}")
        return [run_table(ctx, action, table, as_of, days, dedupe_on_key, latest_only, newest_wins, since_last, changed_only, once)]

    names = list_source_tables(ctx.source)

    def one(name: str) -> JobResult:
        reason = _applicable(action, ctx.spec(name))
        if reason:
            log.info("%s %s: skipped (%s)", action, name, reason)
            return JobResult(name, action, "skipped", note=reason)
        try:
            return run_table(ctx, action, name, as_of, days, dedupe_on_key, latest_only, newest_wins, since_last, changed_only, once)
        except Exception as e:  # noqa: BLE001 - reported per table, raised together below
            log.error("%s %s: failed: %s", action, name, e)
            return JobResult(name, action, "failed", note=f"{type(e).__name__}: {str(e)[:500]}")

    results = _in_reference_order(ctx, action, names, one, max(1, max_concurrent_tables))
    failed = [r.table for r in results if r.status == "failed"]
    if failed:
        raise ActionFailed(f"{action} failed for {failed}", results)
    return results


__all__ = ["ActionFailed", "JobResult", "prepare_and_save", "refresh_table", "insert_table", "update_table",
           "upsert_changes", "append_changes", "run_table", "run_action", "lake_schema"]
