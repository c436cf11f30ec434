"""The driver contract: entry() smoke, and queries() against oracle_sql() in DuckDB on the
smallest scale (the full set runs at sf0.01 with tools/oracle_check.py)."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, rows_of

from helpers import SF_SMALL

FAST = ["derive_partition_columns", "change_window", "change_window_bounds", "has_changes", "latest_per_key",
        "touched_partitions", "unchanged_rows", "merge_image", "align_columns", "update_table",
        "update_moving_rows", "insert_dedupe", "lake_replace_where", "null_partition", "dq_primary_key",
        "dq_foreign_key", "dq_decimal_fit", "change_stamp", "partition_predicate", "table_counts"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"event_id", "ts", "last_updated_at", "partition_date", "year", "month", "day"} <= set(df.columns)


def test_every_query_has_an_oracle():
    assert set(E._QUERIES) == set(E._ORACLES)
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(E.oracle_sql()[name])
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    assert sorted(df.columns) == sorted(c[0] for c in cur.description)
    assert got == want


@pytest.mark.parametrize("spec_name", ["EVENTS_SPEC", "EVENTS_MOVING_SPEC"])
def test_upsert_without_broadcast_matches_oracle(spark, duck, spec_name):
    """Same update with every join forced to shuffle (key set over the broadcast bound and
    the planner's own broadcast switched off): the sort-merge path must give the same lake."""
    from tidewater.plans.context import EngineContext
    from tidewater.plans.jobs import refresh_table, update_table
    from tidewater.session import scratch_path
    from tidewater.sources.files import FrameSource
    from tidewater.sources.lake import lake_scan

    spec = getattr(E, spec_name)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ctx = EngineContext(spark, FrameSource({"events": lambda: E.events_loaded(spark, SF_SMALL)}),
                            scratch_path(spark, "lake", "no-broadcast"), {"events": spec}, broadcast_limit=0)
        refresh_table(ctx, "events")
        ctx.source = FrameSource({"events": lambda: E.events_changed(spark, SF_SMALL)})
        update_table(ctx, "events", E.UPDATE_AS_OF, 1)
        df = lake_scan(spark, ctx.table_path("events"))
        got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    name = "update_table" if spec_name == "EVENTS_SPEC" else "update_moving_rows"
    cur = duck.execute(E.oracle_sql()[name])
    assert got == rows_of([c[0] for c in cur.description], cur.fetchall())


def test_foreign_key_orders_looks_at_all_customers(spark, tmp_path):
    """An order refers to nobody only if no customer at all has its number, whatever the segment."""
    spark.createDataFrame([(1, "BUILDING"), (2, "MACHINERY"), (3, None)], "c_custkey long, c_mktsegment string") \
        .write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(10, 1), (11, 2), (12, 3), (13, 4), (14, 4)], "o_orderkey long, o_custkey long") \
        .write.parquet(f"{tmp_path}/orders.parquet")
    got = E.queries()["dq_foreign_key_orders"](spark, str(tmp_path)).select("o_orderkey", "o_custkey")
    con = duckdb.connect()
    for t in ("customer", "orders"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = con.execute(E.oracle_sql()["dq_foreign_key_orders"]).fetchall()
    assert sorted(map(tuple, got.collect())) == sorted(want) == [(13, 4), (14, 4)]
