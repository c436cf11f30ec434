import datetime as dt

import pytest

from tidewater.plans.context import EngineContext
from tidewater.plans.jobs import refresh_table, update_table
from tidewater.plans.locking import TableLocked, lock_path, table_lock
from tidewater.plans.specs import REFERENCE_TABLES
from tidewater.sources.files import FrameSource, ParquetSource
from tidewater.sources.lake import lake_scan
from tidewater import fs

SCHEMA = "customer_id long, first_name string, created_at timestamp_ntz, last_updated_at timestamp_ntz"
T = dt.datetime


def _ctx(spark, root):
    df = spark.createDataFrame([(1, "a", T(2024, 1, 1), T(2024, 1, 1))], SCHEMA)
    return EngineContext(spark, FrameSource({"customers": df}), root, dict(REFERENCE_TABLES))


def test_a_second_writer_is_refused_while_the_lock_is_held(spark, lake_root):
    ctx = _ctx(spark, lake_root)
    with table_lock(spark, lake_root, "customers", "another job"):
        with pytest.raises(TableLocked):
            refresh_table(ctx, "customers")
        with pytest.raises(TableLocked):
            update_table(ctx, "customers", dt.date(2024, 1, 1), 1)
        refresh_table(EngineContext(spark, ctx.source, lake_root, ctx.tables, locking=False), "customers")
    assert not fs.exists(spark, lock_path(lake_root, "customers"))
    refresh_table(ctx, "customers")  # free again
    assert lake_scan(spark, f"{lake_root}/customers").count() == 1
    assert ParquetSource(spark, lake_root, suffix="").list_tables() == ["customers"]


def test_expired_and_forced_locks(spark, lake_root):
    fs.create_exclusive(spark, lock_path(lake_root, "customers"), "a job that died")
    ctx = _ctx(spark, lake_root)
    with pytest.raises(TableLocked):
        refresh_table(ctx, "customers")
    ctx.lock_ttl_s = 0  # the old lock counts as expired
    refresh_table(ctx, "customers")
    fs.create_exclusive(spark, lock_path(lake_root, "customers"), "another")
    with table_lock(spark, lake_root, "customers", "operator", force=True):
        pass
    assert not fs.exists(spark, lock_path(lake_root, "customers"))
