"""Property test of the streaming ingest: however the change files are batched and in
whatever order they arrive, the lake ends with, per key, the row with the newest change
stamp among the loaded row and all changes (stamps are distinct, so the answer is unique)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidewater.plans.context import EngineContext
from tidewater.plans.jobs import refresh_table
from tidewater.plans.specs import TableSpec
from tidewater.sources.files import FrameSource
from tidewater.sources.lake import lake_scan
from tidewater.streaming.bookmark import ingest_changes

SCHEMA = "k long, v long, created_at timestamp_ntz, last_updated_at timestamp_ntz"
SPEC = TableSpec("t", ("k",), "created_at", "last_updated_at")
DAY0 = dt.datetime(2024, 1, 1)

keys = st.integers(0, 12)
stamps = st.lists(st.integers(0, 10_000), min_size=30, max_size=30, unique=True)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(base_keys=st.sets(keys, max_size=8), batches=st.lists(st.lists(keys, min_size=1, max_size=4),
       min_size=1, max_size=3), pool=stamps, per_file=st.booleans())
def test_stream_matches_model(spark, tmp_path_factory, base_keys, batches, pool, per_file):
    root = str(tmp_path_factory.mktemp("lake"))
    drop = str(tmp_path_factory.mktemp("drop"))
    stamp_of = iter(pool)
    created = {k: DAY0 + dt.timedelta(days=k % 5) for k in range(13)}  # fixed per key
    base = [(k, -1, created[k], DAY0 + dt.timedelta(minutes=next(stamp_of))) for k in sorted(base_keys)]
    ctx = EngineContext(spark, FrameSource({"t": spark.createDataFrame(base, SCHEMA)}), root, {"t": SPEC})
    newest = {r[0]: r for r in base}
    if base:
        refresh_table(ctx, "t")
    for i, batch in enumerate(batches):
        rows_ = [(k, i * 100 + j, created[k], DAY0 + dt.timedelta(minutes=next(stamp_of)))
                 for j, k in enumerate(batch)]
        spark.createDataFrame(rows_, SCHEMA).write.mode("append").parquet(drop)
        for r in rows_:
            if r[0] not in newest or r[3] > newest[r[0]][3]:
                newest[r[0]] = r
        if per_file:
            ingest_changes(ctx, "t", drop, spark.createDataFrame([], SCHEMA).schema)
    if not per_file:
        ingest_changes(ctx, "t", drop, spark.createDataFrame([], SCHEMA).schema)
    got = sorted((r.k, r.v) for r in lake_scan(spark, f"{root}/t").collect())
    assert got == sorted((k, r[1]) for k, r in newest.items())
