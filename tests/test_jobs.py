import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tidewater.plans.context import EngineContext
from tidewater.plans.jobs import insert_table, refresh_table, run_action, update_table
from tidewater.plans.specs import ACTIONS, REFERENCE_TABLES, TableSpec, action_parameters
from tidewater.sources.files import FrameSource
from tidewater.sources.lake import lake_scan

from helpers import rows

T = dt.datetime
CUST = "customer_id long, first_name string, email string, created_at timestamp_ntz, last_updated_at timestamp_ntz"
SPEC = REFERENCE_TABLES["customers"]
MOVING = TableSpec("customers", ("customer_id",), "created_at", "last_updated_at", partition_column="last_updated_at")


def _ctx(spark, root, frames, spec=SPEC):
    return EngineContext(spark, FrameSource(frames), root, {spec.name: spec})


def _customers(spark, data):
    return spark.createDataFrame(data, CUST)


BASE = [
    (1, "Ada", "a@x", T(2024, 1, 1, 8), T(2024, 1, 1, 8)),
    (2, "Bruno", "b@x", T(2024, 1, 1, 9), T(2024, 1, 1, 9)),
    (3, "Carla", "c3@x", T(2024, 1, 2, 10), T(2024, 1, 2, 10)),
    (4, "Dario", "d@x", None, None),
]


def _lake_rows(spark, root, *cols):
    return rows(lake_scan(spark, f"{root}/customers"), *(cols or ("customer_id", "first_name")))


def test_refresh_replaces_everything(spark, lake_root):
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE)})
    refresh_table(ctx, "customers")
    ctx.source = FrameSource({"customers": _customers(spark, BASE[:2])})
    refresh_table(ctx, "customers")
    assert _lake_rows(spark, lake_root) == [(1, "Ada"), (2, "Bruno")]
    lake = lake_scan(spark, f"{lake_root}/customers")
    assert {"partition_date", "year", "month", "day"} <= set(lake.columns)


def test_insert_appends_window_and_dedupes(spark, lake_root):
    src = _customers(spark, BASE + [(5, "Ann", "a@x", T(2024, 1, 2, 23, 59), T(2024, 1, 2, 23, 59))])
    ctx = _ctx(spark, lake_root, {"customers": src})
    insert_table(ctx, "customers", dt.date(2024, 1, 2), 1)  # window (01-01, 01-03): 1, 2, 3, 5
    insert_table(ctx, "customers", dt.date(2024, 1, 3), 1)  # window (01-02, 01-04): 3, 5 again
    assert [r[0] for r in _lake_rows(spark, lake_root)] == [1, 2, 3, 3, 5, 5]
    root2 = lake_root + "2"
    ctx2 = _ctx(spark, root2, {"customers": src})
    for d in (2, 3, 3):
        insert_table(ctx2, "customers", dt.date(2024, 1, d), 1, dedupe_on_key=True)
    assert [r[0] for r in _lake_rows(spark, root2)] == [1, 2, 3, 5]


def test_update_replaces_changed_keys_only(spark, lake_root):
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE)})
    refresh_table(ctx, "customers")
    changed = list(BASE)
    changed[1] = (2, "Cyn", "b@x", T(2024, 1, 1, 9), T(2024, 3, 1, 12))      # in window
    changed[2] = (3, "Matt", "c3@x", T(2024, 1, 2, 10), T(2024, 2, 1, 12))    # outside window
    changed.append((6, "New", "new@x", T(2024, 3, 1, 1), T(2024, 3, 1, 1)))   # new key
    ctx.source = FrameSource({"customers": _customers(spark, changed)})
    res = update_table(ctx, "customers", dt.date(2024, 3, 1), 1)
    assert res.status == "written" and res.change_rows == 2
    assert _lake_rows(spark, lake_root) == [(1, "Ada"), (2, "Cyn"), (3, "Carla"), (4, "Dario"), (6, "New")]
    # stable partitions: only the changed key's partition and the new one were rewritten
    assert sorted(res.affected_partitions) == [(2024, 1, 1), (2024, 3, 1)]
    again = update_table(ctx, "customers", dt.date(2024, 3, 1), 1)
    assert again.status == "written"
    assert _lake_rows(spark, lake_root) == [(1, "Ada"), (2, "Cyn"), (3, "Carla"), (4, "Dario"), (6, "New")]


def test_update_no_changes_writes_nothing(spark, lake_root):
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE)})
    refresh_table(ctx, "customers")
    before = sorted(os.listdir(f"{lake_root}/customers"))
    assert update_table(ctx, "customers", dt.date(2030, 1, 1), 1).status == "no_changes"
    assert sorted(os.listdir(f"{lake_root}/customers")) == before


def test_update_moving_rows_empties_dated_and_null_partitions(spark, lake_root):
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE)}, MOVING)
    refresh_table(ctx, "customers")
    assert (None, None, None) in [tuple(r) for r in
                                  lake_scan(spark, f"{lake_root}/customers").select("year", "month", "day").collect()]
    moved = [
        (1, "Ada", "a@x", T(2024, 1, 1, 8), T(2024, 1, 1, 8)),
        (2, "Bruno", "b@x", T(2024, 1, 1, 9), T(2024, 1, 5, 9)),
        (3, "Carla", "c3@x", T(2024, 1, 2, 10), T(2024, 1, 5, 10)),   # empties 2024-01-02
        (4, "Dario", "d@x", None, T(2024, 1, 5, 11)),                  # empties the NULL partition
    ]
    ctx.source = FrameSource({"customers": _customers(spark, moved)})
    res = update_table(ctx, "customers", dt.date(2024, 1, 5), 1)
    assert sorted(res.dropped_partitions, key=str) == sorted([(2024, 1, 2), (None, None, None)], key=str)
    lake = lake_scan(spark, f"{lake_root}/customers")
    assert rows(lake, "customer_id", "day") == [(1, 1), (2, 5), (3, 5), (4, 5)]
    assert lake.count() == 4
    assert not any("HIVE_DEFAULT" in d for d in os.listdir(f"{lake_root}/customers"))


def test_update_insert_only_and_empty_lake(spark, lake_root):
    fresh = [(7, "Zed", "z@x", T(2024, 5, 1, 1), T(2024, 5, 1, 1))]
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, fresh)})
    assert update_table(ctx, "customers", dt.date(2024, 5, 1), 1).note == "lake was empty"
    ctx.source = FrameSource({"customers": _customers(spark, BASE[:1] + [
        (8, "Yan", "y@x", T(2024, 6, 1, 1), T(2024, 6, 1, 1))]).withColumn("extra", F.lit(1))})
    res = update_table(ctx, "customers", dt.date(2024, 6, 1), 1)
    assert res.note == "insert only"
    lake = lake_scan(spark, f"{lake_root}/customers")
    assert "extra" not in lake.columns  # the lake's columns win
    assert rows(lake, "customer_id") == [(7,), (8,)]


def test_update_latest_only(spark, lake_root):
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE)})
    refresh_table(ctx, "customers")
    dup = [(1, "J1", "a@x", T(2024, 1, 1, 8), T(2024, 2, 1, 1)), (1, "J2", "a@x", T(2024, 1, 1, 8), T(2024, 2, 1, 2))]
    ctx.source = FrameSource({"customers": _customers(spark, dup)})
    update_table(ctx, "customers", dt.date(2024, 2, 1), 1, latest_only=True)
    assert _lake_rows(spark, lake_root)[0] == (1, "J2")
    assert len(_lake_rows(spark, lake_root)) == 4


def test_update_unpartitioned_table(spark, lake_root):
    spec = TableSpec("customers", ("customer_id",), None, "last_updated_at")
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE)}, spec)
    refresh_table(ctx, "customers")
    ctx.source = FrameSource({"customers": _customers(spark, [(2, "Cyn", "b@x", T(2024, 1, 1, 9), T(2024, 3, 1))])})
    update_table(ctx, "customers", dt.date(2024, 3, 1), 1)
    assert _lake_rows(spark, lake_root) == [(1, "Ada"), (2, "Cyn"), (3, "Carla"), (4, "Dario")]


def test_write_gives_one_file_per_small_partition(spark, lake_root):
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet").repartition(16)
    ctx = EngineContext(spark, FrameSource({"events": ev}), lake_root,
                        {"events": TableSpec("events", ("event_id",), "ts")})
    refresh_table(ctx, "events")
    day = f"{lake_root}/events/year=2024/month=1/day=15"
    assert len([f for f in os.listdir(day) if f.endswith(".parquet")]) == 1


def test_action_parameters_and_run_action_errors(spark, lake_root):
    assert action_parameters("insert").time_role == "created"
    assert set(ACTIONS) == {"insert", "update", "refresh"}
    with pytest.raises(ValueError):
        action_parameters("delete")
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE)})
    with pytest.raises(ValueError):
        run_action(ctx, "refresh", "partial")
    with pytest.raises(ValueError):
        run_action(ctx, "refresh", "everything", "customers")
    with pytest.raises(ValueError):
        run_action(ctx, "update", "partial", "transactions")  # no change column


def test_run_action_full_skips_inapplicable_tables(spark, lake_root):
    src = FrameSource({"customers": _customers(spark, BASE),
                       "notes": spark.createDataFrame([(1, "x")], "id int, note string")})
    ctx = EngineContext(spark, src, lake_root, dict(REFERENCE_TABLES))
    res = {r.table: r for r in run_action(ctx, "insert", "full", as_of=dt.date(2024, 1, 2))}
    assert res["customers"].status == "written" and res["notes"].status == "skipped"
    res = {r.table: r for r in run_action(ctx, "refresh", "full", table="ignored")}
    assert all(r.status == "written" for r in res.values())
    assert rows(lake_scan(spark, f"{lake_root}/notes")) == [(1, "x")]


def test_hot_partition_is_split_across_tasks(spark, lake_root):
    """A month holding a third of all rows is written by several tasks (AQE splits the
    skewed rebalance partition), while small months stay one file each."""
    from tidewater.functions.partitions import derive_partition_columns
    from tidewater.sinks.lake import lake_replace

    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").repartition(16)
    hot = li.withColumn("t", F.when(F.col("l_orderkey") % 3 == 0, F.lit(T(1997, 6, 1)))
                        .otherwise(F.col("l_shipdate")))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        lake_replace(derive_partition_columns(hot, "t", "month"), lake_root, ["year", "month"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    hot_files = [f for f in os.listdir(f"{lake_root}/year=1997/month=6") if f.endswith(".parquet")]
    assert len(hot_files) > 1
    assert lake_scan(spark, lake_root).count() == li.count()


def test_refresh_of_empty_source_gives_empty_table(spark, lake_root):
    from tidewater.functions.partitions import derive_partition_columns
    from tidewater.sources.lake import lake_exists

    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE)})
    refresh_table(ctx, "customers")
    empty = _customers(spark, [])
    ctx.source = FrameSource({"customers": empty})
    refresh_table(ctx, "customers")
    assert not lake_exists(spark, f"{lake_root}/customers")
    # an empty table has no footer to infer from: read it with the schema
    schema = derive_partition_columns(empty, "created_at").schema
    assert lake_scan(spark, f"{lake_root}/customers", schema=schema).count() == 0


def test_as_is_layout_skips_the_shuffle(spark, lake_root):
    from tidewater.functions.partitions import derive_partition_columns
    from tidewater.sinks.lake import write_lake

    ev = derive_partition_columns(spark.read.parquet("/root/testdata/sf0.001/events.parquet"), "ts")
    write_lake(ev, lake_root, ["year", "month", "day"], "overwrite", layout="as_is")
    assert lake_scan(spark, lake_root).count() == 1000
    with pytest.raises(ValueError):
        write_lake(ev, lake_root, ["year"], "overwrite", layout="zigzag")


def test_refresh_is_full_replace_even_with_dynamic_session_default(spark, lake_root):
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE)})
    refresh_table(ctx, "customers")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        ctx.source = FrameSource({"customers": _customers(spark, BASE[2:3])})
        refresh_table(ctx, "customers")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    assert _lake_rows(spark, lake_root) == [(3, "Carla")]


def test_refresh_keeps_old_table_when_the_write_fails(spark, lake_root):
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE)})
    refresh_table(ctx, "customers")
    # a source whose read fails at run time (ANSI cast error inside the job)
    broken = _customers(spark, BASE).withColumn("first_name", F.col("first_name").cast("int"))
    ctx.source = FrameSource({"customers": broken})
    with pytest.raises(Exception):
        refresh_table(ctx, "customers")
    assert _lake_rows(spark, lake_root) == [(1, "Ada"), (2, "Bruno"), (3, "Carla"), (4, "Dario")]
    # a later successful refresh drops the partitions the new content does not have
    ctx.source = FrameSource({"customers": _customers(spark, BASE[2:3])})
    res = refresh_table(ctx, "customers")
    assert _lake_rows(spark, lake_root) == [(3, "Carla")]
    assert len(res.dropped_partitions) == 2
    visible = sorted(n for n in os.listdir(f"{lake_root}/customers") if not n.startswith("."))
    assert visible == ["_SUCCESS", "year=2024"]  # no marker left, emptied folders gone


def test_refresh_with_changed_partitioning_replaces_the_layout(spark, lake_root):
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE)})
    refresh_table(ctx, "customers")  # day grain
    ctx.tables = {"customers": TableSpec("customers", ("customer_id",), "created_at", grain="month")}
    refresh_table(ctx, "customers")
    assert _lake_rows(spark, lake_root) == [(1, "Ada"), (2, "Bruno"), (3, "Carla"), (4, "Dario")]
    month_dir = f"{lake_root}/customers/year=2024/month=1"
    assert not any(n.startswith("day=") for n in os.listdir(month_dir))
    ctx.tables = {"customers": TableSpec("customers", ("customer_id",))}  # unpartitioned now
    refresh_table(ctx, "customers")
    assert _lake_rows(spark, lake_root) == [(1, "Ada"), (2, "Bruno"), (3, "Carla"), (4, "Dario")]
    assert "year" not in lake_scan(spark, f"{lake_root}/customers").columns


def test_insert_and_update_refuse_a_differently_partitioned_lake(spark, lake_root):
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE)})
    refresh_table(ctx, "customers")  # day grain
    ctx.tables = {"customers": TableSpec("customers", ("customer_id",), "created_at", "last_updated_at",
                                         grain="month")}
    with pytest.raises(ValueError, match="refresh it"):
        insert_table(ctx, "customers", dt.date(2024, 1, 2), 1)
    with pytest.raises(ValueError, match="refresh it"):
        update_table(ctx, "customers", dt.date(2024, 1, 2), 1)


def test_replaying_an_older_window_does_not_bring_back_old_versions(spark, lake_root):
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE)})
    refresh_table(ctx, "customers")
    v_old = [(2, "Cyn-1", "b@x", T(2024, 1, 1, 9), T(2024, 3, 1, 12))]
    v_new = [(2, "Cyn-2", "b@x", T(2024, 1, 1, 9), T(2024, 3, 5, 12))]
    ctx.source = FrameSource({"customers": _customers(spark, v_new)})
    update_table(ctx, "customers", dt.date(2024, 3, 5), 1)
    ctx.source = FrameSource({"customers": _customers(spark, v_old)})  # a late backfill of 03-01
    update_table(ctx, "customers", dt.date(2024, 3, 1), 1)
    assert dict(_lake_rows(spark, lake_root))[2] == "Cyn-2"
    update_table(ctx, "customers", dt.date(2024, 3, 1), 1, newest_wins=False)  # plain replace
    assert dict(_lake_rows(spark, lake_root))[2] == "Cyn-1"


def test_full_run_reports_every_table_when_one_fails(spark, lake_root):
    from tidewater.plans.jobs import ActionFailed

    broken = _customers(spark, BASE).withColumn("first_name", F.col("first_name").cast("int"))
    src = FrameSource({"customers": broken, "notes": spark.createDataFrame([(1, "x")], "id int, note string")})
    ctx = EngineContext(spark, src, lake_root, dict(REFERENCE_TABLES))
    with pytest.raises(ActionFailed) as err:
        run_action(ctx, "refresh", "full")
    outcome = {r.table: r.status for r in err.value.results}
    assert outcome == {"customers": "failed", "notes": "written"}
    assert rows(lake_scan(spark, f"{lake_root}/notes")) == [(1, "x")]


def test_unpartitioned_refresh_keeps_old_files_until_the_new_ones_are_written(spark, lake_root):
    spec = TableSpec("notes", ("id",))
    ctx = EngineContext(spark, FrameSource({"notes": spark.createDataFrame([(1, "a"), (2, "b")], "id int, n string")}),
                        lake_root, {"notes": spec})
    refresh_table(ctx, "notes")
    broken = spark.createDataFrame([("x", "c")], "id string, n string").withColumn("id", F.col("id").cast("int"))
    ctx.source = FrameSource({"notes": broken})
    with pytest.raises(Exception):
        refresh_table(ctx, "notes")
    assert rows(lake_scan(spark, f"{lake_root}/notes")) == [(1, "a"), (2, "b")]
    ctx.source = FrameSource({"notes": spark.createDataFrame([(3, "c")], "id int, n string")})
    refresh_table(ctx, "notes")
    assert rows(lake_scan(spark, f"{lake_root}/notes")) == [(3, "c")]
    assert not [n for n in os.listdir(f"{lake_root}/notes") if n.startswith(".tidewater-refresh-")]


def test_failed_unpartitioned_update_leaves_the_table_intact(spark, lake_root):
    spec = TableSpec("notes", ("id",), None, "t")
    lake = spark.createDataFrame([(1, 10, T(2024, 1, 1)), (2, 20, T(2024, 1, 1))], "id long, v int, t timestamp_ntz")
    ctx = EngineContext(spark, FrameSource({"notes": lake}), lake_root, {"notes": spec})
    refresh_table(ctx, "notes")
    # the change stages fine as text but cannot be cast to the lake's int column when the
    # new image is written
    bad = spark.createDataFrame([(2, "not a number", T(2024, 2, 1, 5))], "id long, v string, t timestamp_ntz")
    ctx.source = FrameSource({"notes": bad})
    with pytest.raises(Exception):
        update_table(ctx, "notes", dt.date(2024, 2, 1), 1)
    assert rows(lake_scan(spark, f"{lake_root}/notes"), "id", "v") == [(1, 10), (2, 20)]


def test_update_with_a_composite_key(spark, lake_root):
    schema = "o long, line int, qty int, created_at timestamp_ntz, last_updated_at timestamp_ntz"
    spec = TableSpec("lines", ("o", "line"), "created_at", "last_updated_at", grain="month")
    base = [(1, 1, 5, T(2024, 1, 3), T(2024, 1, 3)), (1, 2, 6, T(2024, 1, 3), T(2024, 1, 3)),
            (2, 1, 7, T(2024, 2, 9), T(2024, 2, 9))]
    ctx = EngineContext(spark, FrameSource({"lines": spark.createDataFrame(base, schema)}), lake_root, {"lines": spec})
    refresh_table(ctx, "lines")
    changed = [(1, 2, 60, T(2024, 1, 3), T(2024, 3, 1, 8)), (2, 2, 9, T(2024, 3, 1, 9), T(2024, 3, 1, 9))]
    ctx.source = FrameSource({"lines": spark.createDataFrame(changed, schema)})
    update_table(ctx, "lines", dt.date(2024, 3, 1), 1)
    got = rows(lake_scan(spark, f"{lake_root}/lines"), "o", "line", "qty")
    assert got == [(1, 1, 5), (1, 2, 60), (2, 1, 7), (2, 2, 9)]


def test_missing_spec_columns_are_reported_clearly(spark, lake_root):
    ctx = _ctx(spark, lake_root, {"customers": _customers(spark, BASE).drop("last_updated_at")})
    with pytest.raises(ValueError, match="last_updated_at"):
        update_table(ctx, "customers", dt.date(2024, 1, 2), 1)
    ctx.source = FrameSource({"customers": _customers(spark, BASE).drop("created_at")})
    with pytest.raises(ValueError, match="created_at"):
        insert_table(ctx, "customers", dt.date(2024, 1, 2), 1)
