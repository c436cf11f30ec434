"""Command-line entry: ``python -m tidewater --action update --mode partial --table customers ...``.

Builds (or reuses) the session from spark-submit, a source (Parquet folder or JDBC) and
the table catalogue, runs ``run_action`` and prints one JSON line per table. Errors are
raised, never swallowed: a failed table fails the job.
"""

from __future__ import annotations

import argparse
import json
import logging
import os
import sys
from dataclasses import asdict

from tidewater.plans.context import EngineContext
from tidewater.plans.jobs import ActionFailed, run_action
from tidewater.plans.specs import ACTIONS, REFERENCE_TABLES, TableSpec


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tidewater", description=__doc__.splitlines()[0])
    p.add_argument("--job-name", default="tidewater")
    p.add_argument("--action", required=True, choices=sorted(ACTIONS))
    p.add_argument("--mode", required=True, choices=["full", "partial"])
    p.add_argument("--table", default=None, help="table for partial mode")
    p.add_argument("--lake-root", required=True)
    p.add_argument("--source", choices=["parquet", "jdbc"], default="jdbc")
    p.add_argument("--source-path", help="folder of <table>.parquet for --source parquet")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-schema", default="public")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-user-env", default="TIDEWATER_DB_USER",
                   help="environment variable holding the user name")
    p.add_argument("--jdbc-password-env", default="TIDEWATER_DB_PASSWORD",
                   help="environment variable holding the password")
    p.add_argument("--tables-json", help="JSON file: list of TableSpec fields; default: the financial schema. A table's "
                   "\"jdbc\" object (column, lower_bound, upper_bound, num_partitions) splits its JDBC read; bounds left "
                   "out are asked from the source")
    p.add_argument("--jdbc-fetch-size", type=int, default=10_000)
    p.add_argument("--as-of", default=None, help="window centre date (default: today)")
    p.add_argument("--days", type=int, default=1)
    p.add_argument("--since-last", action="store_true",
                   help="widen the window back to the last successful run of the table and action")
    p.add_argument("--changed-only", action="store_true", help="refresh: rewrite only the partitions that differ from the source")
    p.add_argument("--again", action="store_true", help="insert: append the window's rows even if a run did so before")
    p.add_argument("--dedupe-on-key", action="store_true")
    p.add_argument("--latest-only", action="store_true")
    p.add_argument("--no-newest-wins", action="store_true",
                   help="let every change replace the lake row, even an older one")
    p.add_argument("--max-concurrent-tables", type=int, default=4)
    p.add_argument("--write-layout", choices=["rebalance", "as_is"], default=None,
                   help="default: no shuffle for unpartitioned full copies, rebalance otherwise")
    p.add_argument("--max-records-per-file", type=int, default=None)
    p.add_argument("--broadcast-limit-mb", type=int, default=64,
                   help="largest change-key set broadcast explicitly")
    p.add_argument("--lock-ttl-s", type=float, default=1800,
                   help="time without a heartbeat after which a table lock is a dead job's and may be taken over")
    p.add_argument("--no-locking", action="store_true", help="do not take table writer locks")
    p.add_argument("--cleanup-scratch-hours", type=float, default=None,
                   help="first delete staged change sets older than this (left by dead drivers)")
    a = p.parse_args(argv)
    if a.table in ("", "None", "none"):
        a.table = None
    return a


def load_tables(path: str | None) -> dict[str, TableSpec]:
    if not path:
        return dict(REFERENCE_TABLES)
    with open(path) as f:
        return {d["name"]: TableSpec(**{k: v for k, v in d.items() if k != "jdbc"}) for d in json.load(f)}


def load_partitioning(path: str | None) -> dict:
    """``{table: JdbcPartitioning}`` of the tables whose entry has a ``jdbc`` object."""
    from tidewater.sources.jdbc import JdbcPartitioning

    if not path:
        return {}
    with open(path) as f:
        return {d["name"]: JdbcPartitioning(**d["jdbc"]) for d in json.load(f) if d.get("jdbc")}


def build_source(spark, a: argparse.Namespace):
    if a.source == "parquet":
        from tidewater.sources.files import ParquetSource
        if not a.source_path:
            raise SystemExit("--source parquet needs --source-path")
        return ParquetSource(spark, a.source_path)
    from tidewater.sources.jdbc import JdbcSource
    if not a.jdbc_url:
        raise SystemExit("--source jdbc needs --jdbc-url")
    props = {}
    if os.environ.get(a.jdbc_user_env):
        props["user"] = os.environ[a.jdbc_user_env]
    if os.environ.get(a.jdbc_password_env):
        props["password"] = os.environ[a.jdbc_password_env]
    if a.jdbc_driver:
        props["driver"] = a.jdbc_driver
    return JdbcSource(spark, a.jdbc_url, props, schema=a.jdbc_schema, partitioning=load_partitioning(a.tables_json),
                      fetch_size=a.jdbc_fetch_size)


def main(argv=None) -> int:
    from pyspark.sql import SparkSession

    a = parse_args(argv)
    logging.basicConfig(format="%(asctime)s %(name)s %(levelname)s %(message)s")
    logging.getLogger("tidewater").setLevel(logging.INFO)  # not the gateway's every call
    spark = SparkSession.builder.appName(a.job_name).getOrCreate()
    if a.cleanup_scratch_hours is not None:
        from tidewater.operators.staging import cleanup_scratch
        for path in cleanup_scratch(spark, int(a.cleanup_scratch_hours * 3600)):
            logging.getLogger("tidewater").info("removed stale scratch folder %s", path)
    ctx = EngineContext(spark, build_source(spark, a), a.lake_root, load_tables(a.tables_json),
                        broadcast_limit=a.broadcast_limit_mb * 2**20,
                        max_records_per_file=a.max_records_per_file, write_layout=a.write_layout,
                        locking=not a.no_locking, lock_ttl_s=a.lock_ttl_s)
    try:
        results, code = run_action(ctx, a.action, a.mode, a.table, a.as_of, a.days,
                                   a.dedupe_on_key, a.latest_only, a.max_concurrent_tables,
                                   newest_wins=not a.no_newest_wins, since_last=a.since_last,
                                   changed_only=a.changed_only, once=not a.again), 0
    except ActionFailed as failed:
        results, code = failed.results, 1
    for r in results:
        print(json.dumps(asdict(r), default=str))
    return code


if __name__ == "__main__":
    sys.exit(main())
