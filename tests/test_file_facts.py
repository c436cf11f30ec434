"""Digests and key filters of data files, and the jobs that use them; days as ranges."""

import datetime as dt
import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidewater import fs
from tidewater.functions.partitions import derive_partition_columns, partition_filter
from tidewater.functions.ranges import date_ranges, partition_ranges, range_filter, time_ranges
from tidewater.operators import filefacts
from tidewater.operators.filefacts import facts, file_digests, files_below, files_that_may_hold, key_filters, partition_digests, row_hash
from tidewater.plans import jobs
from tidewater.plans.context import EngineContext
from tidewater.plans.jobs import insert_table, lake_schema, refresh_table, update_table, upsert_changes
from tidewater.plans.specs import TableSpec
from tidewater.sinks.lake import lake_append
from tidewater.sources.files import FrameSource
from tidewater.sources.lake import lake_scan

DAY = ("year", "month", "day")
SCHEMA = "k long, v string, created_at timestamp_ntz, changed_at timestamp_ntz"
SPEC = TableSpec("t", ("k",), created_column="created_at", change_column="changed_at")
D0 = dt.datetime(2024, 1, 1)


def data(days=40, per_day=5):
    return [(d * per_day + i, f"v{d}", D0 + dt.timedelta(days=d, minutes=30 * i), D0 + dt.timedelta(days=d, minutes=30 * i)) for d in range(days) for i in range(per_day)] \
        + [(10_000 + i, "n", None, None) for i in range(3)]


def ctx_of(spark, root, held, spec=SPEC, **kw):
    return EngineContext(spark, FrameSource({"t": spark.createDataFrame(held, SCHEMA)}), root, {"t": spec}, **kw)


def content(spark, root):
    return rows(lake_scan(spark, f"{root}/t").select("k", "v", "created_at", *DAY).na.fill({"v": "-"}), "k", "v", "year", "month", "day")


def written(before, after):
    return sorted({f.rsplit("/", 1)[0] for f in set(after) - set(before)})


# ---------------------------------------------------------------- refresh of changed partitions

def test_only_changed_days_are_rewritten(spark, lake_root, tmp_path):
    held = data()
    ctx = ctx_of(spark, lake_root, held)
    refresh_table(ctx, "t", changed_only=True)  # no table yet: all of it
    path = f"{lake_root}/t"
    before = files_below(spark, path)
    assert refresh_table(ctx, "t", changed_only=True).status == "no_changes"
    assert files_below(spark, path) == before
    changed = [r if r[0] != 7 else (7, "changed", *r[2:]) for r in held if r[0] not in range(50, 55)]  # day 1 edited, day 10 emptied
    changed = [r if r[0] != 100 else (100, None, *r[2:]) for r in changed]  # day 20: a NULL
    changed += [(20_000, "new day", D0 + dt.timedelta(days=300), None)]
    changed = [r for r in changed if r[0] != 10_001] + [(10_003, "other", None, None)]  # the NULL partition
    ctx.source = FrameSource({"t": spark.createDataFrame(changed, SCHEMA)})
    result = refresh_table(ctx, "t", changed_only=True)
    null = "/".join(f"{c}=__HIVE_DEFAULT_PARTITION__" for c in DAY)
    assert written(before, files_below(spark, path)) == sorted(["year=2024/month=1/day=2", "year=2024/month=1/day=21", "year=2024/month=10/day=27", null])
    assert result.dropped_partitions == ["year=2024/month=1/day=11"]
    whole = ctx_of(spark, str(tmp_path / "whole"), changed)
    refresh_table(whole, "t")
    assert content(spark, lake_root) == content(spark, whole.lake_root)
    assert refresh_table(ctx, "t", changed_only=True).status == "no_changes"


def test_digests_see_what_others_wrote(spark, lake_root):
    ctx = ctx_of(spark, lake_root, data(6))
    refresh_table(ctx, "t", changed_only=True)
    refresh_table(ctx, "t", changed_only=True)
    extra = derive_partition_columns(spark.createDataFrame(data(2)[:1], SCHEMA), "created_at")
    lake_append(extra, f"{lake_root}/t", DAY)  # a copy of a row that is there
    assert refresh_table(ctx, "t", changed_only=True).affected_partitions == [(2024, 1, 1)]
    assert len(content(spark, lake_root)) == len(data(6))


def test_added_column_refreshes_the_whole_table(spark, lake_root):
    ctx = ctx_of(spark, lake_root, data(3))
    refresh_table(ctx, "t", changed_only=True)
    ctx.source = FrameSource({"t": spark.createDataFrame(data(3), SCHEMA).withColumn("w", F.lit(1))})
    refresh_table(ctx, "t", changed_only=True)
    assert "w" in lake_scan(spark, f"{lake_root}/t").columns


def test_facts_are_read_once_for_each_file_and_compacted(spark, lake_root, monkeypatch):
    monkeypatch.setattr(filefacts, "_COMPACT_FILES", 3)
    ctx = ctx_of(spark, lake_root, data(4))
    path, args = f"{lake_root}/t", None
    for i in range(6):
        ctx.source = FrameSource({"t": spark.createDataFrame([(k, f"{i}", c, u) for k, _, c, u in data(4)], SCHEMA)})
        refresh_table(ctx, "t", changed_only=True)
        files = files_below(spark, path)
        args = (spark, lake_root, "t", path, files, lake_schema(spark, path, DAY), ["k", "v", "created_at", "changed_at", "partition_date"])
        assert file_digests(*args).count() == len(files)
    store = facts(spark, lake_root, "t", "digests")
    assert store.read().select("file").distinct().count() < 6 * len(files)
    with monkeypatch.context() as m:
        m.setattr(filefacts, "_with_file", None)  # every file is known: none is read
        assert file_digests(*args).count() == len(files)


def test_row_hash_tells_where_nulls_stand(spark):
    df = spark.createDataFrame([("a", None, [1, None], {"x": 1}), (None, "a", [1, None], {"x": 1}), ("a", None, [None, 1], {"x": 1}), ("a", None, [1, None], {"x": 2}),
                                ("a", None, None, None)], "p string, q string, r array<int>, s map<string,int>")
    assert df.select(row_hash(df.schema)).distinct().count() == 5


def test_partition_digests_ignore_order_and_count_copies(spark):
    df = derive_partition_columns(spark.createDataFrame(data(5), SCHEMA), "created_at")
    take = lambda d: rows(partition_digests(d.repartition(3), DAY, ["k", "v"]))
    assert take(df) == take(df.orderBy(F.col("v").desc()))
    twice = df.unionByName(df.where("k = 3"))
    assert len(set(take(twice)) - set(take(df))) == 1


# ---------------------------------------------------------------- key filters

def test_new_keys_open_no_file_and_old_ones_are_found(spark, lake_root):
    ctx = ctx_of(spark, lake_root, data(30, 40))
    refresh_table(ctx, "t")
    path = f"{lake_root}/t"
    files, schema = files_below(spark, path), lake_schema(spark, path, DAY)
    filters = key_filters(spark, lake_root, "t", path, files, schema, ["k"])
    assert filters.count() == len(files)
    keys = lambda values: spark.createDataFrame([(v,) for v in values], "k long")
    assert files_that_may_hold(filters, keys(range(100_000, 101_000)), ["k"]) == []
    for k in (0, 39, 40, 700, 1199, 10_001):
        day = D0 + dt.timedelta(days=k // 40)
        want = f"year={day.year}/month={day.month}/day={day.day}" if k < 10_000 else "/".join(f"{c}=__HIVE_DEFAULT_PARTITION__" for c in DAY)
        assert [f.rsplit("/", 1)[0] for f in files_that_may_hold(filters, keys([k, 555_555]), ["k"])] == [want]
    assert files_that_may_hold(filters, keys([]), ["k"]) == []


def test_many_files_are_read_as_the_table(spark, lake_root, monkeypatch):
    ctx = ctx_of(spark, lake_root, data(8))
    refresh_table(ctx, "t")
    path = f"{lake_root}/t"
    files, schema = files_below(spark, path), lake_schema(spark, path, DAY)
    want = rows(file_digests(spark, f"{lake_root}/a", "t", path, files[1:], schema, ["k", "v"]))
    monkeypatch.setattr(filefacts, "_PATHS_NAMED", 2)
    assert rows(file_digests(spark, f"{lake_root}/b", "t", path, files[1:], schema, ["k", "v"])) == want and len(want) == len(files) - 1


def test_false_hits_are_rare(spark, tmp_path):
    root = str(tmp_path)
    spark.range(50_000).selectExpr("id AS k", "id % 4 AS year").repartition("year").write.partitionBy("year").parquet(f"{root}/t")
    files = files_below(spark, f"{root}/t")
    filters = key_filters(spark, root, "t", f"{root}/t", files, lake_schema(spark, f"{root}/t", ("year",)), ["k"])
    hits = sum(len(files_that_may_hold(filters, spark.range(10**6 + i * 500, 10**6 + i * 500 + 500).toDF("k"), ["k"])) for i in range(4))
    assert hits <= 2  # 8 000 probes at 1e-5


@pytest.mark.parametrize("least", [0, 1 << 60])
def test_key_in_two_days_is_replaced_in_both(spark, lake_root, least):
    """A key that an insert put into a second day has one row after the update, with and without filters."""
    ctx = ctx_of(spark, lake_root, data(20), key_filter_min_bytes=least)
    refresh_table(ctx, "t")
    day5 = D0 + dt.timedelta(days=5)
    ctx.source = FrameSource({"t": spark.createDataFrame([(1, "again", day5 + dt.timedelta(hours=9), day5)], SCHEMA)})
    insert_table(ctx, "t", day5.date(), 1)
    assert [r[0] for r in content(spark, lake_root)].count(1) == 2
    later = day5 + dt.timedelta(days=1)
    ctx.source = FrameSource({"t": spark.createDataFrame([(1, "new", day5 + dt.timedelta(hours=9), later)], SCHEMA)})
    result = update_table(ctx, "t", later.date(), 1)
    assert [r for r in content(spark, lake_root) if r[0] == 1] == [(1, "new", 2024, 1, 6)]
    assert sorted(result.affected_partitions) == [(2024, 1, 1), (2024, 1, 6)]


@pytest.mark.parametrize("least", [0, 1 << 60])
def test_updates_equal_with_and_without_filters(spark, lake_root, least):
    rng = random.Random(8)
    held = {r[0]: r for r in data(15)}
    ctx = ctx_of(spark, lake_root, list(held.values()), key_filter_min_bytes=least)
    refresh_table(ctx, "t")
    for i in range(3):  # known and new keys, moved to other days, into and out of the NULL partition
        changes = []
        for k in rng.sample(sorted(held), 6) + [50_000 + i]:
            made = rng.choice([None, D0 + dt.timedelta(days=rng.randint(0, 25))])
            changes.append((k, f"c{i}", made, D0 + dt.timedelta(days=100 + i)))
        held |= {c[0]: c for c in changes}
        upsert_changes(ctx, "t", spark.createDataFrame(changes, SCHEMA))
        assert [r[:2] for r in content(spark, lake_root)] == sorted((k, r[1]) for k, r in held.items())


def test_update_of_new_keys_reads_no_other_partition(spark, lake_root, monkeypatch):
    ctx = ctx_of(spark, lake_root, data(10), key_filter_min_bytes=0)
    refresh_table(ctx, "t")
    upsert_changes(ctx, "t", spark.createDataFrame([(70_000, "a", D0, D0)], SCHEMA))  # builds the filters
    seen = []
    real = jobs.touched_partitions
    monkeypatch.setattr(jobs, "touched_partitions", lambda *a: seen.append(a) or real(*a))
    upsert_changes(ctx, "t", spark.createDataFrame([(70_001, "a", D0, D0)], SCHEMA))
    assert seen == [] and len(content(spark, lake_root)) == len(data(10)) + 2


# ---------------------------------------------------------------- ranges

def test_ten_years_of_days_become_one_term():
    days = [dt.date(2014, 1, 1) + dt.timedelta(days=i) for i in range(3650)]
    parts = [(d.year, d.month, d.day) for d in days]
    assert partition_ranges(parts) == [((2014, 1, 1), (2023, 12, 29))]
    assert len(partition_ranges([p for p in parts if p not in {(2016, 2, 29), (2020, 5, 1)}])) == 3
    assert partition_ranges([(2023, 12), (2024, 1), (2024, 3)]) == [((2023, 12), (2024, 1)), ((2024, 3), (2024, 3))]
    assert partition_ranges([(2023,), (2024,)]) == [((2023,), (2024,))]
    assert partition_ranges([(None, None, None)]) == []


def test_range_filters_select_the_same_rows_and_prune(spark, lake_root):
    rng = random.Random(2)
    ctx = ctx_of(spark, lake_root, data(90, 2))
    refresh_table(ctx, "t")
    lake, source = lake_scan(spark, f"{lake_root}/t"), ctx.source.table("t")
    for grain, cols in (("day", DAY), ("month", DAY[:2]), ("year", DAY[:1])):
        derived = derive_partition_columns(source, "created_at", grain)
        for _ in range(4):
            some = [tuple(r) for r in lake.select(*cols).distinct().collect() if rng.random() < 0.6]
            want = rows(lake.where(partition_filter(some, cols)), "k")
            assert rows(lake.where(range_filter(some, cols)), "k") == want
            assert rows(lake.where(~range_filter(some, cols)), "k") == sorted(set(rows(lake, "k")) - set(want))
            assert rows(derived.where(time_ranges(source, "created_at", some, grain)), "k") == want
    pruned = lake.where(range_filter([(2024, 1, 3), (2024, 1, 4)], DAY))
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: []" in plan and pruned.select("_metadata.file_path").distinct().count() == 2
    assert rows(date_ranges(lake), "first_day", "last_day", "days") == [(None, None, 1), (dt.date(2024, 1, 1), dt.date(2024, 3, 30), 90)]


def test_listing_agrees_with_the_file_system(spark, tmp_path):
    spark.range(10).selectExpr("id", "id % 3 AS p").write.partitionBy("p").parquet(f"{tmp_path}/t")
    root = fs.qualify(spark, f"{tmp_path}/t")
    found = fs.data_files(spark, f"{tmp_path}/t", f"{tmp_path}/none")
    assert found and all(f.startswith(root) and fs.exists(spark, f) for f in found)
    assert sorted(found) == sorted(fs.data_files(spark, *[f"{tmp_path}/t/p={i}" for i in range(3)]))
    assert fs.existing(spark, [f"{tmp_path}/t/p={i}" for i in range(60)]) == [f"{tmp_path}/t/p={i}" for i in range(3)]


# ---------------------------------------------------------------- checks of what changed, ranges of equal weight

def test_unique_check_of_changes_equals_the_full_one(spark, lake_root):
    from tidewater.operators.quality import dq_unique
    from tidewater.plans.checks import dq_unique_changed
    from tidewater.plans.jobs import append_changes

    rng = random.Random(6)
    ctx, path = ctx_of(spark, lake_root, data(12)), f"{lake_root}/t"
    refresh_table(ctx, "t")
    previous = dq_unique(lake_scan(spark, path), ["k"])
    for i in range(4):
        day = D0 + dt.timedelta(days=rng.randint(0, 14))
        if i % 2 == 0:  # copies of keys of other days, and new ones
            added = [(rng.randint(0, 60), "x", day, day) for _ in range(4)] + [(None, "null", day, day)] * 2 + [(90_000, "twice", day, day)] * 2
            append_changes(ctx, "t", spark.createDataFrame(added, SCHEMA))
            parts = [(day.year, day.month, day.day)]
        else:  # an update takes repeats away
            repeats = [r["k"] for r in previous.collect()][:3]
            changes = [(k, "one", day, D0 + dt.timedelta(days=50 + i)) for k in repeats]
            parts = upsert_changes(ctx, "t", spark.createDataFrame(changes, SCHEMA)).affected_partitions
        got = dq_unique_changed(ctx, "t", ["k"], parts, previous)
        assert rows(got, "k", "n") == rows(dq_unique(lake_scan(spark, path), ["k"]), "k", "n")
        previous = spark.createDataFrame(got.collect(), "k long, n long")


@pytest.mark.parametrize("limit", [1 << 26, 100])
def test_reference_check_of_changes_equals_the_full_one(spark, lake_root, limit):
    from tidewater.operators.quality import dq_missing_references
    from tidewater.plans.checks import dq_foreign_key_changed
    from tidewater.plans.jobs import append_changes

    rng = random.Random(7)
    children = "k long, ref long, created_at timestamp_ntz"
    parents = list(range(0, 40))
    specs = {"c": TableSpec("c", ("k",), created_column="created_at"), "p": TableSpec("p", ("id",)), "u": TableSpec("u", ("k",))}
    held = [(i, i % 50 if i % 9 else None, D0 + dt.timedelta(days=i % 10)) for i in range(200)]
    frame = lambda ids: spark.createDataFrame([(i, "x") for i in [*ids, None]], "id int, v string")
    ctx = EngineContext(spark, FrameSource({"c": spark.createDataFrame(held, children), "u": spark.createDataFrame(held, children), "p": frame(parents)}),
                        lake_root, specs, broadcast_limit=limit)
    for name in specs:
        refresh_table(ctx, name)

    def full(child="c"):
        return dq_missing_references(lake_scan(spark, f"{lake_root}/{child}"), lake_scan(spark, f"{lake_root}/p"), ["ref"], ["id"])

    assert rows(dq_foreign_key_changed(ctx, "u", "p", ["ref"], ["id"]), "ref", "n_refs") == rows(full("u"), "ref", "n_refs")
    previous = full()
    assert {r["ref"] for r in previous.collect()} == set(range(40, 50))
    for step in range(4):
        removed, parts = None, []
        if step != 1:  # new references: known ones, unknown ones, none, and one that the parent's type can't hold
            day = D0 + dt.timedelta(days=rng.randint(0, 12))
            added = [(1000 * (step + 1) + i, r, day) for i, r in enumerate([3, 45, 77 + step, None, 1 << 40, *rng.sample(range(60), 3)])]
            append_changes(ctx, "c", spark.createDataFrame(added, children))
            parts = [(day.year, day.month, day.day)]
        if step:  # parents come and go
            gone = rng.sample(parents, 4)
            parents = [p for p in parents if p not in gone] + [40 + step, 500 + step]
            removed = frame([*gone, *rng.sample(parents, 2)])
            ctx.source = FrameSource({"p": frame(parents)})
            refresh_table(ctx, "p")
        got = dq_foreign_key_changed(ctx, "c", "p", ["ref"], ["id"], parts, removed, previous)
        assert rows(got, "ref", "n_refs") == rows(full(), "ref", "n_refs")
        previous = spark.createDataFrame(got.collect(), "ref long, n_refs long")
    assert dq_foreign_key_changed(ctx, "c", "p", ["ref"], ["id"]).isEmpty()  # nothing changed, nothing was missing


def test_ranges_of_equal_weight(spark):
    from tidewater.sources.jdbc import range_predicates, split_points

    skewed = spark.range(20_000).select((F.pow(F.lit(1.0008), F.col("id"))).cast("long").alias("k"), F.col("id").alias("i"))
    for df, column in ((skewed, "k"), (skewed.selectExpr("date_add(DATE'2020-01-01', CAST(k % 5000 AS INT)) AS d", "i"), "d")):
        points = split_points(df, column, 8)
        counts = [df.where(p).count() for p in range_predicates(column, points)]
        assert sum(counts) == 20_000 and max(counts) <= 2 * min(counts)
    held = spark.createDataFrame([(None,), (5,), (5,), (5,), (7,)], "k int")
    points = split_points(held, "k", 4)
    assert sum(held.where(p).count() for p in range_predicates("k", points)) == 5
    assert split_points(held.limit(0), "k", 4) == [] and range_predicates("k", []) == ["1 = 1"]
    with pytest.raises(ValueError):
        range_predicates("k", ["a'b"])
