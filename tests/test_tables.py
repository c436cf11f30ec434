"""Compaction, clustered writes, columns that change, and the order of tables in a full run."""

import datetime as dt
import random
import threading

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidewater import fs
from tidewater.functions.curve import z_order
from tidewater.operators.filefacts import files_below
from tidewater.plans import compaction, jobs
from tidewater.plans.compaction import compact_table, pack_files
from tidewater.plans.context import EngineContext
from tidewater.plans.evolution import logged_schema, read_table
from tidewater.plans.jobs import ActionFailed, append_changes, refresh_table, run_action, upsert_changes
from tidewater.plans.specs import REFERENCE_TABLES, TableSpec
from tidewater.sources.files import FrameSource
from tidewater.sources.lake import lake_scan

SCHEMA = "k long, v string, created_at timestamp_ntz"
SPEC = TableSpec("t", ("k",), created_column="created_at")
FLAT = TableSpec("t", ("k",))
D0 = dt.datetime(2024, 1, 1)


def ctx_of(spark, root, spec=SPEC, **kw):
    return EngineContext(spark, FrameSource({}), root, {"t": spec}, **kw)


def fill(spark, ctx, times=5):
    for i in range(times):
        data = [(i * 100 + j, f"v{j}", D0 + dt.timedelta(days=j % 3) if j % 4 else None) for j in range(24)]
        append_changes(ctx, "t", spark.createDataFrame(data, SCHEMA).coalesce(1))


# ---------------------------------------------------------------- compaction

def test_bins():
    assert pack_files([("a", 80), ("b", 10), ("c", 10)], 100) == [["b", "c"]]
    assert pack_files([("a", 60), ("b", 60), ("c", 30), ("d", 30), ("e", 1)], 100) == [["a", "c", "e"], ["b", "d"]]
    assert pack_files([("a", 5)], 100) == [] == pack_files([], 100)
    rng = random.Random(1)
    files = [(f"f{i}", rng.randint(1, 120)) for i in range(200)]
    bins, size = pack_files(files, 100), dict(files)
    assert all(sum(size[f] for f in b) <= 100 and len(b) > 1 for b in bins)
    assert len({f for b in bins for f in b}) == sum(len(b) for b in bins)


@pytest.mark.parametrize("spec", [SPEC, FLAT])
def test_same_rows_in_few_files(spark, lake_root, spec):
    ctx, path = ctx_of(spark, lake_root, spec), f"{lake_root}/t"
    fill(spark, ctx)
    before, count = rows(lake_scan(spark, path).na.fill({"v": ""}).select("k", "v")), len(files_below(spark, path))
    compact_table(ctx, "t")
    folders = {f.rsplit("/", 1)[0] if "/" in f else "" for f in files_below(spark, path)}
    assert len(files_below(spark, path)) == len(folders) < count
    assert rows(lake_scan(spark, path).select("k", "v")) == before
    assert compact_table(ctx, "t").status == "no_changes"


def test_only_the_listed_partitions(spark, lake_root):
    ctx, path = ctx_of(spark, lake_root), f"{lake_root}/t"
    fill(spark, ctx)
    compact_table(ctx, "t", partitions=[(2024, 1, 2)])
    counts = {}
    for f in files_below(spark, path):
        counts[f.rsplit("/", 1)[0]] = counts.get(f.rsplit("/", 1)[0], 0) + 1
    assert counts["year=2024/month=1/day=2"] == 1 and counts["year=2024/month=1/day=1"] == 5


def test_files_of_bounded_size(spark, lake_root):
    ctx, path = ctx_of(spark, lake_root, FLAT), f"{lake_root}/t"
    fill(spark, ctx, 9)
    one = fs.files_with_sizes(spark, path)[0][1]
    compact_table(ctx, "t", target_bytes=int(one * 3.5))
    assert len(files_below(spark, path)) == 3


@pytest.mark.parametrize("step", ["before the plan", "before the moves", "between the moves", "before the deletions", "between the deletions"])
def test_a_killed_compaction_is_finished(spark, lake_root, monkeypatch, step):
    ctx, path = ctx_of(spark, lake_root), f"{lake_root}/t"
    fill(spark, ctx)
    before = rows(lake_scan(spark, path).select("k", "v"))
    real_rename, real_delete, seen = fs.rename, fs.delete, []

    def die(*a):
        raise KeyboardInterrupt

    def rename(s, src, dst):
        if "part-" in src:
            seen.append(src)
            if step == "before the moves" or step == "between the moves" and len(seen) > 1:
                die()
        return real_rename(s, src, dst)

    def delete(s, p, recursive=True):
        if "part-" in p:
            seen.append(p)
            if step == "before the deletions" or step == "between the deletions" and len([x for x in seen if ".tidewater" not in x]) > 2:
                die()
        return real_delete(s, p, recursive)

    with monkeypatch.context() as m:
        m.setattr(jobs, "_MOVES_AT_ONCE", 1)
        m.setattr(jobs.fs, "rename", rename)
        m.setattr(jobs.fs, "delete", delete)
        if step == "before the plan":
            m.setattr(compaction, "fs", fs)
            m.setattr(jobs, "write_swap_plan", die)
        with pytest.raises(KeyboardInterrupt):
            compact_table(ctx, "t")
    append_changes(ctx, "t", spark.createDataFrame([(999, "after", D0)], SCHEMA))  # any job puts it right first
    assert rows(lake_scan(spark, path).select("k", "v")) == sorted([*before, (999, "after")])
    assert not [c for c in fs.list_children(spark, path) if c.startswith((".tidewater", "_tidewater"))]


# ---------------------------------------------------------------- clustered writes

def test_row_groups_are_narrow_in_every_clustering_column(spark, lake_root):
    import glob

    import pyarrow.parquet as pq

    data = spark.range(40_000).select(F.col("id").alias("k"), (F.xxhash64("id") % 100_000).alias("x"), F.sha1(F.col("id").cast("string")).alias("y"),
                                      F.when(F.col("id") % 2 == 0, F.lit("2024-01-01 00:00:00")).otherwise("2024-01-02 00:00:00").cast("timestamp_ntz").alias("created_at"))
    shares = {}
    for cluster in ((), ("x",), ("x", "y")):
        ctx = ctx_of(spark, f"{lake_root}/{len(cluster)}", TableSpec("t", ("k",), created_column="created_at", cluster_by=cluster))
        ctx.source, ctx.max_records_per_file = FrameSource({"t": data}), 500
        refresh_table(ctx, "t")
        assert lake_scan(spark, ctx.table_path("t")).select("k", "x", "y").exceptAll(data.select("k", "x", "y")).isEmpty()
        bounds = {"x": [], "y": []}
        for f in glob.glob(f"{ctx.table_path('t')}/*/*/*/*.parquet"):
            meta = pq.ParquetFile(f).metadata
            for g in range(meta.num_row_groups):
                for c in range(meta.num_columns):
                    column = meta.row_group(g).column(c)
                    if column.path_in_schema in bounds:
                        bounds[column.path_in_schema].append((column.statistics.min, column.statistics.max))
        probes = {"x": [-90_000, -5, 0, 777, 90_000], "y": ["0a", "55", "99", "f0"]}
        shares[cluster] = {c: sum(a <= p <= b for p in probes[c] for a, b in bounds[c]) / (len(probes[c]) * len(bounds[c])) for c in bounds}
    assert shares[()]["x"] > 0.9 and shares[()]["y"] > 0.9
    assert shares[("x",)]["x"] < 0.1
    assert shares[("x", "y")]["x"] < 0.35 and shares[("x", "y")]["y"] < 0.35


def test_curve_takes_every_kind_of_column(spark):
    df = spark.sql("""SELECT id AS i, CAST(id AS DECIMAL(10,2)) AS d, id % 2 = 0 AS b, date_add(DATE'2024-01-01', CAST(id AS INT)) AS t,
        timestamp_ntz'2024-01-01 00:00:00' + make_interval(0,0,0,CAST(id AS INT)) AS n, CAST(id AS STRING) AS s, CAST(NULL AS INT) AS z FROM range(200)""")
    places = [r[0] for r in df.select(z_order(df, ["i", "d", "b", "t", "n", "s", "z"]).alias("p")).collect()]
    assert len(set(places)) > 50 and min(places) >= 0
    order = [r[0] for r in df.select("i", z_order(df, ["i"]).alias("p")).orderBy("p", "i").collect()]
    assert order == list(range(200))
    with pytest.raises(ValueError):
        z_order(spark.sql("SELECT map('a', 1) AS m"), ["m"])


# ---------------------------------------------------------------- columns that change

EVOLVING = TableSpec("t", ("k",), created_column="created_at", change_column="u", evolve=True)
OLD = "k int, v string, created_at timestamp_ntz, u timestamp_ntz"


def test_added_and_widened_columns(spark, lake_root):
    ctx = ctx_of(spark, lake_root, EVOLVING)
    append_changes(ctx, "t", spark.createDataFrame([(1, "a", D0, D0), (2, "b", D0 + dt.timedelta(days=1), D0)], OLD))
    wide = "w double, k long, v string, created_at timestamp_ntz, u timestamp_ntz"
    append_changes(ctx, "t", spark.createDataFrame([(0.5, 2**40, "c", D0, D0)], wide))
    assert rows(read_table(ctx, "t"), "k", "v", "w") == [(1, "a", None), (2, "b", None), (2**40, "c", 0.5)]
    later = D0 + dt.timedelta(days=9)
    upsert_changes(ctx, "t", spark.createDataFrame([(1.5, 2, "b2", D0 + dt.timedelta(days=1), later), (2.5, 7, "new", D0, later)], wide))
    want = [(1, "a", None), (2, "b2", 1.5), (7, "new", 2.5), (2**40, "c", 0.5)]
    assert rows(read_table(ctx, "t"), "k", "v", "w") == want
    append_changes(ctx, "t", spark.createDataFrame([(3.5, 8, "narrow", D0, D0)], "w float, k int, v string, created_at timestamp_ntz, u timestamp_ntz"))
    assert rows(read_table(ctx, "t"), "k", "v", "w") == sorted([*want, (8, "narrow", 3.5)])
    assert [f.name for f in logged_schema(ctx, "t").fields] == ["k", "v", "created_at", "u", "partition_date", "w", "year", "month", "day"]


@pytest.mark.parametrize("schema", ["k int, v int, created_at timestamp_ntz, u timestamp_ntz", "k int, created_at timestamp_ntz, u timestamp_ntz",
                                    "k string, v string, created_at timestamp_ntz, u timestamp_ntz"])
def test_conflicts_are_errors_and_write_nothing(spark, lake_root, schema):
    ctx = ctx_of(spark, lake_root, EVOLVING)
    append_changes(ctx, "t", spark.createDataFrame([(1, "a", D0, D0)], OLD))
    with pytest.raises(ValueError, match="lake"):
        append_changes(ctx, "t", spark.createDataFrame([], schema))
    assert rows(read_table(ctx, "t"), "k", "v") == [(1, "a")]


def test_a_refresh_starts_the_columns_anew(spark, lake_root):
    ctx = ctx_of(spark, lake_root, EVOLVING)
    append_changes(ctx, "t", spark.createDataFrame([(1, "a", D0, D0)], OLD))
    append_changes(ctx, "t", spark.createDataFrame([(1, "a", D0, D0, 3)], OLD + ", x int"))
    ctx.source = FrameSource({"t": spark.createDataFrame([(5, "z", D0, D0)], OLD)})
    refresh_table(ctx, "t")
    assert read_table(ctx, "t").columns == ["k", "v", "created_at", "u", "partition_date", "year", "month", "day"]
    assert rows(read_table(ctx, "t"), "k") == [(5,)]


# ---------------------------------------------------------------- order of tables

def _run(monkeypatch, ctx, action="refresh", fail=(), **kw):
    begun, ended, lock = [], [], threading.Lock()

    def run(ctx, action, name, *a):
        with lock:
            begun.append((name, set(ended)))
        if name in fail:
            raise RuntimeError(name)
        with lock:
            ended.append(name)
        return jobs.JobResult(name, action, "written")

    monkeypatch.setattr(jobs, "run_table", run)
    try:
        return begun, run_action(ctx, action, "full", **kw)
    except ActionFailed as e:
        return begun, e.results


def test_parents_first_and_children_of_failures_left_out(spark, lake_root, monkeypatch):
    tables = {**REFERENCE_TABLES, "cards": TableSpec("cards", references=("accounts", "customers")), "alone": TableSpec("alone")}
    ctx = EngineContext(spark, FrameSource({n: None for n in tables}), lake_root, tables)
    begun, results = _run(monkeypatch, ctx)
    done = dict(begun)
    assert "customers" in done["accounts"] and {"accounts", "customers"} <= done["cards"] and "accounts" in done["transactions"]
    assert [r.status for r in results] == ["written"] * 5
    for at_once in (1, 4):
        begun, results = _run(monkeypatch, ctx, fail=("accounts",), max_concurrent_tables=at_once)
        status = {r.table: r.status for r in results}
        assert status == {"customers": "written", "accounts": "failed", "transactions": "skipped", "cards": "skipped", "alone": "written"}
        assert {n for n, _ in begun} == {"customers", "accounts", "alone"}


def test_a_circle_is_an_error(spark, lake_root):
    tables = {"a": TableSpec("a", references=("b",)), "b": TableSpec("b", references=("a",))}
    with pytest.raises(ValueError, match="circle"):
        run_action(EngineContext(spark, FrameSource({"a": None, "b": None}), lake_root, tables), "refresh", "full")
