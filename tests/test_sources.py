import pytest

from tidewater.plans.context import EngineContext
from tidewater.plans.specs import REFERENCE_TABLES
from tidewater.sources.catalog import list_source_tables, scan_one_or_many, table_counts
from tidewater.sources.files import FrameSource, ParquetSource
from tidewater.sources.jdbc import JdbcPartitioning, JdbcSource
from tidewater.sources.lake import lake_exists, lake_partition_scan
from tidewater.sinks.lake import drop_partitions, lake_append
from tidewater.functions.partitions import derive_partition_columns

from helpers import SF_SMALL, rows

NAMES = ["benchmark", "conversations", "customer", "documents", "embeddings", "events", "labels",
         "lineitem", "nation", "orders", "pages", "part", "region", "supplier"]


def test_parquet_source(spark):
    src = ParquetSource(spark, SF_SMALL)
    assert list_source_tables(src) == NAMES
    assert src.table("region").count() == 5
    many = scan_one_or_many(src, table_list=["region", "nation"])
    assert list(many) == ["region", "nation"] and many["nation"].count() == 25
    assert scan_one_or_many(src, table_name="region").columns == ["r_regionkey", "r_name"]
    with pytest.raises(ValueError):
        scan_one_or_many(src)
    counts = dict((r.table_name, r.n) for r in table_counts(src, ["region", "nation"]).collect())
    assert counts == {"region": 5, "nation": 25}
    assert table_counts(src, []).count() == 0


def test_frame_source(spark):
    df = spark.range(3)
    src = FrameSource({"a": df, "b": lambda: spark.range(2)})
    assert src.list_tables() == ["a", "b"] and src.table("b").count() == 2
    with pytest.raises(KeyError):
        src.table("c")


def test_jdbc_source_options_without_a_database(spark):
    # Only the read options are checked: this environment runs no database.
    src = JdbcSource(spark, "jdbc:postgresql://db:5432/app", {"user": "u"}, schema="public",
                     partitioning={"transactions": JdbcPartitioning("account_id", 1, 1_000_000, 64)})
    assert src.read_options("customers") == {"dbtable": "public.customers"}
    opts = src.read_options("transactions")
    assert opts["partitionColumn"] == "account_id" and opts["numPartitions"] == "64"
    assert opts["lowerBound"] == "1" and opts["upperBound"] == "1000000"
    with pytest.raises(ValueError):
        JdbcPartitioning("created_at").options()  # bounds come from the source at read time


def test_engine_context(spark):
    src = FrameSource({})
    ctx = EngineContext(spark, src, "s3a://bucket/lake/", dict(REFERENCE_TABLES))
    assert ctx.spark is spark and ctx.source is src
    assert ctx.table_path("customers") == "s3a://bucket/lake/customers"
    assert ctx.spec("customers").keys == ("customer_id",)
    assert ctx.spec("other").keys == ()


def test_partition_scan_and_drop(spark, lake_root):
    ev = derive_partition_columns(spark.read.parquet(f"{SF_SMALL}/events.parquet"), "ts")
    lake_append(ev, lake_root, ["year", "month", "day"])
    assert lake_exists(spark, lake_root) and not lake_exists(spark, lake_root + "-none")
    part = lake_partition_scan(spark, lake_root, [(2024, 1, 3), (2030, 1, 1)])
    assert {"year", "month", "day", "partition_date"} <= set(part.columns)
    assert rows(part.select("day").distinct()) == [(3,)]
    assert lake_partition_scan(spark, lake_root, [(2030, 1, 1)]) is None
    dropped = drop_partitions(spark, lake_root, [(2024, 1, 3)], ["year", "month", "day"])
    assert len(dropped) == 1 and lake_partition_scan(spark, lake_root, [(2024, 1, 3)]) is None


def test_partition_scan_many_partitions_uses_listing(spark, lake_root):
    import datetime as dt
    ev = derive_partition_columns(spark.read.parquet(f"{SF_SMALL}/events.parquet"), "ts")
    lake_append(ev, lake_root, ["year", "month", "day"])
    wanted = [(d.year, d.month, d.day) for d in (dt.date(2023, 12, 1) + dt.timedelta(days=i) for i in range(90))]
    part = lake_partition_scan(spark, lake_root, wanted)
    assert part.count() == ev.count()  # all 30 January days exist, the other 60 are skipped


def test_hidden_folders_are_not_lake_data(spark, tmp_path):
    from tidewater import fs

    root = tmp_path / "t"
    (root / ".spark-staging-1" / "year=2024").mkdir(parents=True)
    (root / ".spark-staging-1" / "year=2024" / "part-0.parquet").write_bytes(b"x")
    (root / "_SUCCESS").write_bytes(b"")
    assert not lake_exists(spark, str(root))
    (root / "year=2024").mkdir()
    spark.range(3).write.parquet(str(root / "year=2024" / "d"))
    assert lake_exists(spark, str(root))
    assert "/year=2024/d/part-" in fs.first_data_file(spark, str(root))


def test_parquet_source_lists_only_tables(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "a.parquet"))
    spark.range(3).write.parquet(str(tmp_path / "b"))
    (tmp_path / "notes.txt").write_text("not a table")
    (tmp_path / "_tmp").mkdir()
    src = ParquetSource(spark, str(tmp_path))
    assert src.list_tables() == ["a", "b"]
    assert src.table("a").count() == 2 and src.table("b").count() == 3


def test_jdbc_read_failure_is_logged_and_raised(spark, caplog):
    # No database runs here: a URL no driver accepts fails at load(), which must surface.
    src = JdbcSource(spark, "jdbc:nosuchdriver://nowhere/db", {})
    with caplog.at_level("ERROR", logger="tidewater"), pytest.raises(Exception):
        src.table("customers")
    assert any("customers" in r.getMessage() for r in caplog.records)
