"""Inserts that happen once: batches, crashes between their steps, high-water marks."""

import datetime as dt
import random

import pytest
from helpers import rows

from tidewater import fs
from tidewater.plans import jobs, marks
from tidewater.plans.context import EngineContext
from tidewater.plans.jobs import insert_table, refresh_table, run_action
from tidewater.plans.marks import insert_new_rows, read_mark
from tidewater.plans.specs import TableSpec
from tidewater.sinks import batches
from tidewater.sources.files import FrameSource
from tidewater.sources.lake import lake_scan

SCHEMA = "k long, v string, created_at timestamp_ntz"
SPEC = TableSpec("t", ("k",), created_column="created_at")
AS_OF = dt.date(2024, 3, 10)
T0 = dt.datetime(2024, 3, 9, 12)
ROWS = [(i, f"v{i}", T0 + dt.timedelta(hours=i * 5)) for i in range(1, 8)]


def ctx_of(spark, root, data):
    return EngineContext(spark, FrameSource({"t": spark.createDataFrame(data, SCHEMA)}), root, {"t": SPEC})


def keys(spark, root):
    return [k for k, in rows(lake_scan(spark, f"{root}/t"), "k")]


def test_repeated_window_adds_nothing(spark, lake_root):
    ctx = ctx_of(spark, lake_root, ROWS)
    assert [r.status for r in run_action(ctx, "insert", "partial", "t", as_of=AS_OF)] == ["written"]
    want = keys(spark, lake_root)
    assert want == [1, 2, 3, 4, 5, 6, 7]
    assert [r.status for r in run_action(ctx, "insert", "partial", "t", as_of=AS_OF)] == ["no_changes"]
    assert keys(spark, lake_root) == want
    insert_table(ctx, "t", AS_OF, 1)  # the plain job appends again
    assert len(keys(spark, lake_root)) == 2 * len(want)


@pytest.mark.parametrize("step", ["before the plan", "before the moves", "between the moves", "after the moves", "before the deletion"])
def test_each_row_once_whatever_step_a_job_dies_in(spark, lake_root, monkeypatch, step):
    ctx = ctx_of(spark, lake_root, ROWS)
    real_rename, real_delete, real_text, moved = fs.rename, fs.delete, fs.write_text_at_once, []

    def die(*a):
        raise KeyboardInterrupt

    def rename(s, src, dst):
        if "part-" in src:
            if step == "before the moves" or step == "between the moves" and moved:
                die()
            moved.append(src)
        if step == "after the moves" and dst.endswith(".done"):
            die()
        return real_rename(s, src, dst)

    with monkeypatch.context() as m:
        m.setattr(batches, "_MOVES_AT_ONCE", 1)
        m.setattr(batches.fs, "rename", rename)
        if step == "before the plan":
            m.setattr(batches.fs, "write_text_at_once", die)
        if step == "before the deletion":
            m.setattr(batches.fs, "delete", lambda s, p, *a: die() if batches.STAGING_PREFIX in p else real_delete(s, p, *a))
        with pytest.raises(KeyboardInterrupt):
            insert_table(ctx, "t", AS_OF, 1, once=True)
    insert_table(ctx, "t", AS_OF, 1, once=True)
    assert keys(spark, lake_root) == [1, 2, 3, 4, 5, 6, 7]
    assert not [c for c in fs.list_children(spark, f"{lake_root}/t") if c.startswith(batches.STAGING_PREFIX)]
    insert_table(ctx, "t", AS_OF, 1, once=True)
    assert keys(spark, lake_root) == [1, 2, 3, 4, 5, 6, 7]


def test_an_interrupted_batch_is_finished_by_the_next_job_of_any_kind(spark, lake_root, monkeypatch):
    ctx = ctx_of(spark, lake_root, ROWS)
    with monkeypatch.context() as m:
        m.setattr(batches, "_finish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            insert_table(ctx, "t", AS_OF, 1, once=True)
    ctx.source = FrameSource({"t": spark.createDataFrame([(9, "x", T0 + dt.timedelta(days=2))], SCHEMA)})
    insert_table(ctx, "t", AS_OF + dt.timedelta(days=1), 1, once=True)
    assert keys(spark, lake_root) == [1, 2, 3, 4, 5, 6, 7, 9]


def test_batch_names():
    assert batches._name("insert-2024-03-10-1") == "insert-2024-03-10-1"
    assert batches._name("a/b") != batches._name("a_b") and "/" not in batches._name("a/../b")


def test_irregular_runs_equal_one_run(spark, lake_root, tmp_path):
    """Rows reach the source late, up to a day after their stamp; runs come at odd times, some twice."""
    rng = random.Random(4)
    data = []
    for i in range(200):
        stamp = dt.datetime(2024, 3, 1) + dt.timedelta(minutes=rng.randint(0, 8 * 1440), microseconds=rng.choice([0, 1, 999999]))
        data.append(((i, f"v{i}", stamp), stamp + dt.timedelta(minutes=rng.choice([0, 0, 0, rng.randint(0, 1440)]))))
    data += [((900, "null", None), dt.datetime(2024, 3, 1)), ((901, "edge", data[0][0][2]), data[0][1] + dt.timedelta(hours=20))]
    ctx = ctx_of(spark, lake_root, [])
    now = dt.datetime(2024, 3, 1)
    while now < dt.datetime(2024, 3, 12):
        now += dt.timedelta(hours=rng.choice([3, 30, 55]))
        ctx.source = FrameSource({"t": spark.createDataFrame([r for r, seen in data if seen <= now], SCHEMA)})
        for _ in range(rng.choice([1, 2])):
            insert_new_rows(ctx, "t", dt.timedelta(days=1, hours=1))
    want = sorted(r[0] for r, _ in data if r[2] is not None)
    assert keys(spark, lake_root) == want
    one = ctx_of(spark, str(tmp_path / "one"), [r for r, _ in data])
    insert_new_rows(one, "t")
    assert keys(spark, one.lake_root) == want
    assert read_mark(one, "t")[1] == read_mark(ctx, "t")[1] == max(r[2] for r, _ in data if r[2])


@pytest.mark.parametrize("step", ["before the batch", "before the state has its name"])
def test_marks_survive_crashes(spark, lake_root, monkeypatch, step):
    ctx = ctx_of(spark, lake_root, ROWS[:3])
    insert_new_rows(ctx, "t")
    ctx.source = FrameSource({"t": spark.createDataFrame(ROWS[:5], SCHEMA)})
    with monkeypatch.context() as m:
        where = (jobs, "_append_changes") if step == "before the batch" else (marks, "_name_state")
        m.setattr(*where, lambda *a, **k: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            insert_new_rows(ctx, "t")
    ctx.source = FrameSource({"t": spark.createDataFrame(ROWS, SCHEMA)})  # and more has come
    insert_new_rows(ctx, "t")
    assert keys(spark, lake_root) == [1, 2, 3, 4, 5, 6, 7]
    assert insert_new_rows(ctx, "t").status == "no_changes"


def test_a_job_whose_lock_was_taken_over_writes_nothing(spark, lake_root, monkeypatch):
    from tidewater.plans.locking import TableLocked, lock_path

    ctx = ctx_of(spark, lake_root, ROWS)
    refresh_table(ctx, "t")
    files = set(fs.data_files(spark, f"{lake_root}/t"))
    ctx.source = FrameSource({"t": spark.createDataFrame([(i, "new", c) for i, _, c in ROWS], SCHEMA)})

    def taken(*a, **k):  # another job takes the lock while this one works
        fs.write_text(spark, lock_path(lake_root, "t"), "another job")
        return real(*a, **k)

    for job in (lambda: refresh_table(ctx, "t"), lambda: insert_table(ctx, "t", AS_OF, 1), lambda: insert_table(ctx, "t", AS_OF, 1, once=True),
                lambda: jobs.upsert_changes(ctx, "t", ctx.source.table("t"))):
        real = jobs.derive_partition_columns
        with monkeypatch.context() as m:
            m.setattr(jobs, "derive_partition_columns", taken)
            with pytest.raises(TableLocked):
                job()
        assert set(fs.data_files(spark, f"{lake_root}/t")) == files
        fs.delete(spark, lock_path(lake_root, "t"))


def test_a_fresh_lock_is_not_taken_for_the_stale_one(spark, lake_root):
    from tidewater.plans.locking import TableLocked, _take_away, lock_path

    lock = lock_path(lake_root, "t")
    fs.write_text(spark, lock, "fresh")
    with pytest.raises(TableLocked):
        _take_away(spark, lock, "stale")
    assert fs.read_text(spark, lock) == "fresh"
    _take_away(spark, lock, "fresh")
    assert not fs.exists(spark, lock)
