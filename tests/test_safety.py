"""Failures, drift and lateness: nothing is lost, doubled or changed without a word."""

import datetime as dt
import json
import os
import time

import pytest

from tidewater import fs
from tidewater.operators.changes import latest_per_key
from tidewater.functions.partitions import derive_partition_columns
from tidewater.plans import jobs
from tidewater.plans.cli import build_source, load_tables, parse_args
from tidewater.plans.context import EngineContext
from tidewater.plans.jobs import append_changes, insert_table, last_success, refresh_table, run_table, update_table, upsert_changes
from tidewater.plans.locking import TableLocked, lock_path, table_lock
from tidewater.plans.specs import TableSpec
from tidewater.operators.staging import ALIVE, cleanup_scratch, materialise
from tidewater.sources.files import FrameSource
from tidewater.sources.lake import lake_scan
from tidewater.streaming.bookmark import ingest_changes

from helpers import rows

T = dt.datetime
SCHEMA = "k long, v string, created timestamp_ntz, changed timestamp_ntz"
FLAT = TableSpec("t", ("k",), change_column="changed")
DAILY = TableSpec("t", ("k",), "created", "changed")
BASE = [(1, "a", T(2024, 1, 1), T(2024, 1, 1)), (2, "b", T(2024, 1, 2), T(2024, 1, 2))]
NEW = [(1, "a2", T(2024, 1, 1), T(2024, 1, 5, 3)), (3, "c", T(2024, 1, 5, 2), T(2024, 1, 5, 2))]
AS_OF = dt.date(2024, 1, 5)


def ctx_of(spark, root, spec, data, schema=SCHEMA):
    return EngineContext(spark, FrameSource({"t": spark.createDataFrame(data, schema)}), root, {"t": spec})


def lake(spark, root, *cols):
    return rows(lake_scan(spark, f"{root}/t"), *(cols or ("k", "v")))


AFTER = [(1, "a2"), (2, "b"), (3, "c")]


@pytest.mark.parametrize("broken", ["false", "raises", "second", "delete", "killed"])
def test_unpartitioned_swap_survives_failures(spark, lake_root, monkeypatch, broken):
    ctx = ctx_of(spark, lake_root, FLAT, BASE)
    refresh_table(ctx, "t")
    ctx.source = FrameSource({"t": spark.createDataFrame(NEW, SCHEMA)})
    real_rename, real_delete, calls = fs.rename, fs.delete, []

    def rename(s, src, dst):
        if "part-" not in src:
            return real_rename(s, src, dst)
        calls.append(src)
        if broken == "false" or broken == "second" and len(calls) > 1:
            return False
        if broken == "raises":
            raise OSError("store is away")
        return real_rename(s, src, dst)

    def delete(s, path, recursive=True):
        if broken in ("delete", "killed") and "part-" in path:
            raise OSError("store is away")
        return real_delete(s, path, recursive)

    with monkeypatch.context() as m:
        m.setattr(jobs.fs, "rename", rename)
        m.setattr(jobs.fs, "delete", delete)
        if broken == "killed":  # nothing after the moves happens, the undoing of them included
            m.setattr(jobs, "_finish_swap", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        fails = broken != "second"
        if fails:
            with pytest.raises(KeyboardInterrupt if broken == "killed" else OSError):
                update_table(ctx, "t", AS_OF, 1)
        if broken in ("false", "raises"):
            assert lake(spark, lake_root) == [(1, "a"), (2, "b")]  # the old table, whole
    update_table(ctx, "t", AS_OF, 1)
    assert lake(spark, lake_root) == AFTER
    left = [n for n in os.listdir(f"{lake_root}/t") if not n.endswith((".parquet", ".crc")) and n != "_SUCCESS"]
    assert left == []


def test_corrected_created_stamp_leaves_one_row(spark, lake_root):
    ctx = ctx_of(spark, lake_root, DAILY, BASE)
    refresh_table(ctx, "t")
    ctx.source = FrameSource({"t": spark.createDataFrame([(1, "a2", T(2023, 12, 31), T(2024, 1, 5, 3))], SCHEMA)})
    result = update_table(ctx, "t", AS_OF, 1)
    assert lake(spark, lake_root) == [(1, "a2"), (2, "b")]
    assert result.dropped_partitions == [(2024, 1, 1)] and not os.path.exists(f"{lake_root}/t/year=2024/month=1/day=1")


def test_schema_rules(spark, lake_root):
    ctx = ctx_of(spark, lake_root, DAILY, BASE)
    refresh_table(ctx, "t")
    short = spark.createDataFrame([(1, T(2024, 1, 1), T(2024, 1, 5, 3))], "k long, created timestamp_ntz, changed timestamp_ntz")
    for job in (lambda df: upsert_changes(ctx, "t", df), lambda df: append_changes(ctx, "t", df)):
        with pytest.raises(ValueError, match="not in the rows to write"):
            job(short)
    drifted = spark.createDataFrame([(4, 7, T(2024, 1, 1), T(2024, 1, 5, 3))], SCHEMA.replace("v string", "v int"))
    with pytest.raises(ValueError, match="v: int to string"):
        append_changes(ctx, "t", drifted)
    with pytest.raises(ValueError, match="NULL in key"):
        upsert_changes(ctx, "t", spark.createDataFrame([(None, "x", T(2024, 1, 1), T(2024, 1, 5, 3))], SCHEMA))
    append_changes(ctx, "t", spark.createDataFrame([(4, "d", T(2024, 1, 3), None)], SCHEMA.replace("k long", "k int")))
    assert lake(spark, lake_root) == [(1, "a"), (2, "b"), (4, "d")]
    with pytest.raises(ValueError, match="names of partition columns"):
        derive_partition_columns(spark.createDataFrame([(1999, T(2024, 1, 1))], "year int, created timestamp_ntz"), "created")


def test_null_keys_are_never_merged(spark, lake_root):
    ctx = ctx_of(spark, lake_root, DAILY, BASE)
    refresh_table(ctx, "t")
    fresh = [(None, "x", T(2024, 1, 5, 1), None), (None, "y", T(2024, 1, 5, 1), None), (2, "old", T(2024, 1, 5, 1), None),
             (5, "first", T(2024, 1, 5, 1), T(2024, 1, 5, 1)), (5, "second", T(2024, 1, 5, 1), T(2024, 1, 5, 2))]
    ctx.source = FrameSource({"t": spark.createDataFrame(fresh, SCHEMA)})
    insert_table(ctx, "t", AS_OF, 1, dedupe_on_key=True)
    assert sorted(lake(spark, lake_root), key=str) == sorted([(None, "x"), (None, "y"), (1, "a"), (2, "b"), (5, "second")], key=str)


def test_latest_per_key_keeps_columns_without_order(spark):
    df = spark.createDataFrame([(1, None, {"a": 1}), (2, T(2024, 1, 1), {"b": 2}), (2, None, {"c": 3}), (None, None, None)],
                               "k long, t timestamp_ntz, m map<string,int>")
    got = {(r.k, r.t): r.m for r in latest_per_key(df, ["k"], "t").collect()}
    assert got == {(1, None): {"a": 1}, (2, T(2024, 1, 1)): {"b": 2}, (None, None): None}


def test_insert_and_stream_read_their_rows_once(spark, lake_root, tmp_path):
    spec = TableSpec("t", ("k",), "created", "changed", partition_column="changed")
    ctx = ctx_of(spark, lake_root, spec, BASE)
    refresh_table(ctx, "t")
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    df = spark.createDataFrame(NEW, SCHEMA)
    ctx.source = FrameSource({"t": df.mapInArrow(count, df.schema)})
    insert_table(ctx, "t", AS_OF, 1, dedupe_on_key=True)
    assert read.value == len(NEW)
    assert lake(spark, lake_root) == [(1, "a"), (2, "b"), (3, "c")]


def test_lock_of_a_long_job_is_not_taken_over(spark, lake_root):
    with table_lock(spark, lake_root, "t", "long job", ttl_s=2):
        time.sleep(4)  # longer than the limit: the heartbeat keeps the lock alive
        with pytest.raises(TableLocked):
            with table_lock(spark, lake_root, "t", "second", ttl_s=2):
                pass
    assert not fs.exists(spark, lock_path(lake_root, "t"))


def test_a_lost_lock_is_reported_and_not_deleted(spark, lake_root):
    with pytest.raises(TableLocked, match="taken over"):
        with table_lock(spark, lake_root, "t", "first"):
            with table_lock(spark, lake_root, "t", "operator", force=True):
                pass
            fs.write_text(spark, lock_path(lake_root, "t"), "a third job")
    assert fs.read_text(spark, lock_path(lake_root, "t")) == "a third job"


def test_cleanup_spares_staged_rows_of_a_live_job(spark):
    staged = materialise(spark.range(3), "live")
    old = int((time.time() - 100_000) * 1000)
    fs.set_modification_time(spark, staged.path, old)
    assert staged.path not in cleanup_scratch(spark, 3600) and staged.df.count() == 3
    fs.set_modification_time(spark, f"{staged.path}/{ALIVE}", old)
    assert any(p.endswith(staged.path.rsplit("/", 1)[1]) for p in cleanup_scratch(spark, 3600))
    staged.release()


def test_refresh_drops_partitions_whatever_their_time_stamps(spark, lake_root):
    ctx = ctx_of(spark, lake_root, DAILY, BASE)
    refresh_table(ctx, "t")
    future = int((time.time() + 3600) * 1000)
    for f in fs.data_files(spark, f"{lake_root}/t"):
        fs.set_modification_time(spark, f, future)
    ctx.source = FrameSource({"t": spark.createDataFrame(BASE[1:], SCHEMA)})
    assert refresh_table(ctx, "t").dropped_partitions == ["year=2024/month=1/day=1"]
    assert lake(spark, lake_root) == [(2, "b")]


def test_one_bookmark_for_each_action_and_folder(spark, lake_root, tmp_path):
    drop = str(tmp_path / "drop")
    ctx = ctx_of(spark, lake_root, DAILY, BASE)
    refresh_table(ctx, "t")
    df = spark.createDataFrame(NEW, SCHEMA)
    df.write.parquet(drop)
    ingest_changes(ctx, "t", drop, df.schema, action="insert")
    assert lake(spark, lake_root) == [(1, "a"), (2, "b"), (3, "c")]
    ingest_changes(ctx, "t", drop, df.schema, action="update")
    assert lake(spark, lake_root) == AFTER


def test_since_last_makes_up_for_missed_days(spark, lake_root):
    ctx = ctx_of(spark, lake_root, DAILY, BASE)
    run_table(ctx, "refresh", "t", "2024-01-02")
    run_table(ctx, "update", "t", "2024-01-02")
    ctx.source = FrameSource({"t": spark.createDataFrame(NEW, SCHEMA)})
    run_table(ctx, "update", "t", "2024-01-09")  # the runs from the 3rd to the 8th were missed
    assert lake(spark, lake_root) == [(1, "a"), (2, "b")]
    assert last_success(ctx, "update", "t") == dt.date(2024, 1, 9)
    fs.write_text(spark, jobs.bookmark_path(ctx, "update", "t"), "2024-01-02")
    run_table(ctx, "update", "t", "2024-01-09", since_last=True)
    assert lake(spark, lake_root) == AFTER
    run_table(ctx, "update", "t", "2024-01-03")
    assert last_success(ctx, "update", "t") == dt.date(2024, 1, 9)


def test_jdbc_options_of_the_command_line(spark, tmp_path):
    tables = tmp_path / "tables.json"
    tables.write_text(json.dumps([{"name": "t", "keys": ["k"], "created_column": "created",
                                   "jdbc": {"column": "k", "lower_bound": 1, "upper_bound": 900, "num_partitions": 12}}, {"name": "u"}]))
    a = parse_args(["--action", "refresh", "--mode", "full", "--lake-root", "/l", "--jdbc-url", "jdbc:x:y", "--tables-json", str(tables),
                    "--jdbc-fetch-size", "500", "--since-last"])
    assert load_tables(str(tables))["t"].keys == ("k",) and a.since_last
    source = build_source(spark, a)
    assert source.fetch_size == 500
    assert source.read_options("t") == {"dbtable": "public.t", "partitionColumn": "k", "lowerBound": "1", "upperBound": "900", "numPartitions": "12"}
    assert source.read_options("u") == {"dbtable": "public.u"}
