import datetime as dt

from tidewater.plans.context import EngineContext
from tidewater.plans.jobs import refresh_table
from tidewater.plans.specs import TableSpec
from tidewater.sources.files import FrameSource
from tidewater.sources.lake import lake_scan
from tidewater.streaming.bookmark import checkpoint_location, export_changes, ingest_changes

from helpers import rows

T = dt.datetime
SCHEMA = "id long, v string, created_at timestamp_ntz, last_updated_at timestamp_ntz"
SPEC = TableSpec("items", ("id",), "created_at", "last_updated_at")


def test_stream_upsert_processes_each_file_once(spark, tmp_path):
    root, drop = str(tmp_path / "lake"), str(tmp_path / "drop")
    base = spark.createDataFrame([(1, "a", T(2024, 1, 1), T(2024, 1, 1)), (2, "b", T(2024, 1, 2), T(2024, 1, 2))],
                                 SCHEMA)
    ctx = EngineContext(spark, FrameSource({"items": base}), root, {"items": SPEC})
    refresh_table(ctx, "items")
    v1 = spark.createDataFrame([(1, "a1", T(2024, 1, 1), T(2024, 2, 1, 5)), (2, "b", T(2024, 1, 2), T(2024, 1, 2)),
                                (3, "c", T(2024, 2, 1, 6), T(2024, 2, 1, 6))], SCHEMA)
    ctx.source = FrameSource({"items": v1})
    export_changes(ctx, "items", drop, dt.date(2024, 2, 1), 1)
    ingest_changes(ctx, "items", drop, v1.schema)
    assert rows(lake_scan(spark, f"{root}/items"), "id", "v") == [(1, "a1"), (2, "b"), (3, "c")]
    # the second run sees only the new file; two versions of key 2 arrive in one batch
    v2 = spark.createDataFrame([(2, "b1", T(2024, 1, 2), T(2024, 3, 1, 1)), (2, "b2", T(2024, 1, 2), T(2024, 3, 1, 2))],
                               SCHEMA)
    ctx.source = FrameSource({"items": v2})
    export_changes(ctx, "items", drop, dt.date(2024, 3, 1), 1)
    q = ingest_changes(ctx, "items", drop, v1.schema)
    assert rows(lake_scan(spark, f"{root}/items"), "id", "v") == [(1, "a1"), (2, "b2"), (3, "c")]
    assert q.lastProgress is not None
    assert checkpoint_location(ctx, "items", "update", drop).startswith(root)


def test_stream_insert_dedupes(spark, tmp_path):
    root, drop = str(tmp_path / "lake"), str(tmp_path / "drop")
    src = spark.createDataFrame([(1, "a", T(2024, 1, 1, 5), None), (2, "b", T(2024, 1, 2, 5), None)], SCHEMA)
    ctx = EngineContext(spark, FrameSource({"items": src}), root, {"items": SPEC})
    for d in (1, 2, 2):
        export_changes(ctx, "items", drop, dt.date(2024, 1, d), 1, role="created")
        ingest_changes(ctx, "items", drop, src.schema, action="insert")
    assert rows(lake_scan(spark, f"{root}/items"), "id") == [(1,), (2,)]


def test_stream_insert_dedupes_inside_one_batch(spark, tmp_path):
    root, drop = str(tmp_path / "lake"), str(tmp_path / "drop")
    src = spark.createDataFrame([(1, "a", T(2024, 1, 1, 5), None), (2, "b", T(2024, 1, 2, 5), None)], SCHEMA)
    ctx = EngineContext(spark, FrameSource({"items": src}), root, {"items": SPEC})
    for d in (1, 2):  # overlapping windows exported before one run: row 1 arrives twice
        export_changes(ctx, "items", drop, dt.date(2024, 1, d), 1, role="created")
    ingest_changes(ctx, "items", drop, src.schema, action="insert")
    assert rows(lake_scan(spark, f"{root}/items"), "id") == [(1,), (2,)]


def test_stream_keeps_newest_version_when_files_arrive_out_of_order(spark, tmp_path):
    root, drop = str(tmp_path / "lake"), str(tmp_path / "drop")
    base = spark.createDataFrame([(1, "a", T(2024, 1, 1), T(2024, 1, 1))], SCHEMA)
    ctx = EngineContext(spark, FrameSource({"items": base}), root, {"items": SPEC})
    refresh_table(ctx, "items")
    newer = spark.createDataFrame([(1, "new", T(2024, 1, 1), T(2024, 3, 2))], SCHEMA)
    older = spark.createDataFrame([(1, "old", T(2024, 1, 1), T(2024, 2, 1))], SCHEMA)
    newer.write.mode("append").parquet(drop)  # arrives first
    older.write.mode("append").parquet(drop)  # a late file with an older change
    q = ingest_changes(ctx, "items", drop, newer.schema, max_files_per_trigger=1)
    assert rows(lake_scan(spark, f"{root}/items"), "id", "v") == [(1, "new")]
    assert q.lastProgress is not None
