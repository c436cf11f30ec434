import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions.partitions import (
    derive_partition_columns,
    partition_dir,
    partition_filter,
    partition_key_strings,
    partition_path,
    partition_predicate_frame,
)
from tidewater.functions.windows import change_window_condition, window_bounds, window_partition_dates
from tidewater.functions.stamps import change_stamp, column_defaults
from tidewater.sinks.lake import lake_replace
from tidewater.sources.lake import lake_scan

from helpers import rows

# Partition-date cases: string times in, (year, month, day) out.
CASES = [
    ("opened", ["2020-02-29 00:00:01.500", "1999-12-31 23:59:59.999"], [(2020, 2, 29), (1999, 12, 31)]),
    ("touched", ["2018-7-4 06:05:04.000", "2022-11-3"], [(2018, 7, 4), (2022, 11, 3)]),
    ("opened", ["2031-04-30", "2001-9-9 01:46:40"], [(2031, 4, 30), (2001, 9, 9)]),
]


@pytest.mark.parametrize("column,values,expected", CASES)
def test_derive_partition_columns_parses(spark, column, values, expected):
    df = spark.createDataFrame([(v,) for v in values], [column])
    out = derive_partition_columns(df, column)
    assert [tuple(r) for r in out.select("year", "month", "day").collect()] == expected
    assert out.schema["partition_date"].dataType.simpleString() == "date"
    assert out.schema["year"].dataType.simpleString() == "int"


def test_unparseable_time_gives_null_partition(spark):
    df = spark.createDataFrame([("2016-08",), ("2016/08/05",), ("2016-08-05 04:03:02.000",), (None,), ("abc",)],
                               ["last_updated_at"])
    got = [tuple(r) for r in derive_partition_columns(df, "last_updated_at").select("year", "month", "day").collect()]
    # year-month parses to the first day; the slash form, NULL and junk give the NULL partition
    assert got == [(2016, 8, 1), (None, None, None), (2016, 8, 5), (None, None, None), (None, None, None)]


def test_month_grain(spark):
    df = spark.createDataFrame([(dt.datetime(1996, 3, 9, 12),)], ["o_orderdate"])
    out = derive_partition_columns(df, "o_orderdate", grain="month")
    assert out.columns == ["o_orderdate", "partition_date", "year", "month"]
    with pytest.raises(ValueError):
        derive_partition_columns(df, "o_orderdate", grain="week")


def test_partition_texts():
    assert partition_dir("s3://b/lake/t/", (2024, 1, 5)) == "s3://b/lake/t/year=2024/month=1/day=5"
    assert partition_dir("/l", (None, None, None)).endswith("year=__HIVE_DEFAULT_PARTITION__/"
                                                            "month=__HIVE_DEFAULT_PARTITION__/"
                                                            "day=__HIVE_DEFAULT_PARTITION__")


def test_partition_frames(spark):
    df = spark.createDataFrame([(2024, 1, 5), (2024, 1, 5), (None, None, None)], "year int, month int, day int")
    conds = sorted(r.cond for r in partition_predicate_frame(df).collect())
    assert conds == ["(year = '2024' AND month = '1' AND day = '5')",
                     "(year IS NULL AND month IS NULL AND day IS NULL)"]
    paths = sorted((r.p for r in df.select(partition_path(base="/root").alias("p")).distinct().collect()),
                   key=str)
    assert paths == ["/root/year=2024/month=1/day=5", None]
    strs = partition_key_strings(df).schema
    assert [f.dataType.simpleString() for f in strs.fields] == ["string"] * 3


def test_partition_filter_prunes(spark, lake_root):
    df = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2)), (3, None), (4, dt.date(2024, 2, 1))],
        "id int, d date")
    lake_replace(derive_partition_columns(df, "d"), lake_root, ["year", "month", "day"])
    lake = lake_scan(spark, lake_root)
    picked = lake.where(partition_filter([(2024, 1, 2), (None, None, None)]))
    assert rows(picked, "id") == [(2,), (3,)]
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partition" in plan.lower()
    assert rows(lake.where(partition_filter([])), "id") == []


def test_window_bounds_and_dates():
    assert window_bounds(dt.date(2024, 1, 15), 1) == (dt.date(2024, 1, 14), dt.date(2024, 1, 16))
    assert window_bounds("2024-01-15", 30) == (dt.date(2023, 12, 16), dt.date(2024, 2, 14))
    assert window_partition_dates(dt.date(2024, 1, 15), 1) == [dt.date(2024, 1, 14), dt.date(2024, 1, 15)]
    with pytest.raises(ValueError):
        window_bounds(dt.date(2024, 1, 15), -1)


@pytest.mark.parametrize("days", [1, 7, 30])
def test_window_is_exclusive_both_ends(spark, days):
    as_of = dt.date(2024, 3, 1)
    lo, hi = window_bounds(as_of, days)
    stamps = [dt.datetime.combine(lo, dt.time()), dt.datetime.combine(lo, dt.time(0, 0, 1)),
              dt.datetime.combine(hi, dt.time()) - dt.timedelta(microseconds=1), dt.datetime.combine(hi, dt.time()),
              None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stamps)], "i int, t timestamp_ntz")
    assert rows(df.where(change_window_condition("t", as_of, days)), "i") == [(1,), (2,)]


def test_window_filter_is_pushed_to_parquet(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = df.where(change_window_condition("ts", dt.date(2024, 1, 15), 1))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,2024-01-14T00:00)" in plan and "LessThan(ts,2024-01-16T00:00)" in plan


def test_change_stamp_and_defaults(spark):
    df = spark.createDataFrame([(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2020, 1, 1)), (3, None)],
                               "id long, last_updated_at timestamp_ntz")
    keys = spark.createDataFrame([(2,), (2,), (9,)], "id long")
    out = change_stamp(df, keys, ["id"], "last_updated_at", dt.datetime(2024, 1, 15))
    assert out.columns == df.columns
    assert rows(out) == [(1, dt.datetime(2020, 1, 1)), (2, dt.datetime(2024, 1, 15)), (3, None)]
    acc = spark.createDataFrame([(1, None, None), (2, "FROZEN", 5.5)], "id int, status string, balance double")
    filled = column_defaults(acc, {"status": "OPEN", "balance": 0.0})
    assert rows(filled) == [(1, "OPEN", 0.0), (2, "FROZEN", 5.5)]
    stamped = column_defaults(df, {"last_updated_at": F.lit(dt.datetime(2030, 1, 1))})
    assert stamped.schema["last_updated_at"].dataType.simpleString() == "timestamp_ntz"
