import json
import os
import subprocess
import sys

import duckdb

import __spark_entry__ as E

from helpers import SF_SMALL

HERE = os.path.dirname(os.path.abspath(__file__))


def test_jobs_give_the_same_lake_when_tasks_fail_and_retry(tmp_path):
    marks = tmp_path / "failures"
    proc = subprocess.run([sys.executable, os.path.join(HERE, "retry_job.py"), str(tmp_path / "lake"), str(marks)],
                          capture_output=True, text=True, timeout=600)
    assert proc.returncode == 0, proc.stderr[-2000:]
    out = json.loads(proc.stdout.strip().splitlines()[-1])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    n_loaded = con.execute("SELECT COUNT(*) FROM events WHERE ts < TIMESTAMP '2024-01-25 00:00:00'").fetchone()[0]
    assert out["after_refresh"] == n_loaded
    want = sorted((r[0], r[1], str(r[2]))
                  for r in con.execute(E.CDC + "SELECT event_id, value, last_updated_at FROM img").fetchall())
    assert [tuple(r) for r in out["rows"]] == want
    assert len(os.listdir(marks)) >= 4  # tasks really failed and were retried
