import json

import pytest

from tidewater.plans.cli import load_tables, main, parse_args
from tidewater.sources.lake import lake_scan

from helpers import SF_SMALL


def test_parse_args_none_table():
    a = parse_args(["--action", "refresh", "--mode", "full", "--lake-root", "/l", "--table", "None"])
    assert a.table is None and a.days == 1
    assert a.write_layout is None and a.broadcast_limit_mb == 64
    with pytest.raises(SystemExit):
        parse_args(["--action", "merge", "--mode", "full", "--lake-root", "/l"])


def test_cli_runs_partial_refresh_on_parquet(spark, lake_root, tmp_path, capsys):
    tables = tmp_path / "tables.json"
    tables.write_text(json.dumps([{"name": "events", "keys": ["event_id"], "created_column": "ts"}]))
    assert load_tables(str(tables))["events"].keys == ("event_id",)
    rc = main(["--action", "refresh", "--mode", "partial", "--table", "events", "--lake-root", lake_root,
               "--source", "parquet", "--source-path", SF_SMALL, "--tables-json", str(tables)])
    assert rc == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["table"] == "events" and out["status"] == "written"
    assert lake_scan(spark, f"{lake_root}/events").count() == 1000


def test_cli_update_full_skips_tables_without_change_column(spark, lake_root, tmp_path, capsys):
    tables = tmp_path / "tables.json"
    tables.write_text(json.dumps([
        {"name": "events", "keys": ["event_id"], "created_column": "ts", "change_column": "ts"},
    ]))
    common = ["--lake-root", lake_root, "--source", "parquet", "--source-path", SF_SMALL,
              "--tables-json", str(tables), "--max-concurrent-tables", "2"]
    assert main(["--action", "refresh", "--mode", "partial", "--table", "events"] + common) == 0
    capsys.readouterr()
    assert main(["--action", "update", "--mode", "full", "--as-of", "2024-01-15"] + common) == 0
    results = {d["table"]: d for d in map(json.loads, capsys.readouterr().out.strip().splitlines())}
    assert results["events"]["status"] == "written" and results["events"]["change_rows"] > 0
    assert results["region"]["status"] == "skipped"
    lake = lake_scan(spark, f"{lake_root}/events")
    assert lake.count() == 1000 and lake.select("event_id").distinct().count() == 1000
