"""Property test: update_table against a brute-force model of the upsert on random fixtures.

Model: after the update, the lake holds every base row whose key is not in the change
window, plus every change row in the window that is not older than the lake's row for its
key; each row sits in the partition of its partitioning column; no other partition
directory exists.
"""

import datetime as dt
import os

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st

from tidewater.plans.context import EngineContext
from tidewater.plans.jobs import refresh_table, update_table
from tidewater.plans.specs import TableSpec
from tidewater.sources.files import FrameSource
from tidewater.sources.lake import lake_exists, lake_scan

SCHEMA = "k long, v long, created_at timestamp_ntz, last_updated_at timestamp_ntz"
AS_OF = dt.date(2024, 1, 10)
DAY0 = dt.datetime(2024, 1, 1)


def _stamp(hours):
    return None if hours is None else DAY0 + dt.timedelta(hours=hours)


times = st.one_of(st.none(), st.integers(min_value=0, max_value=14 * 24))
# change stamps land in the window (2024-01-09 .. 2024-01-10) most of the time
stamps = st.one_of(st.integers(min_value=8 * 24 + 1, max_value=10 * 24 - 1), times)
base_rows = st.dictionaries(st.integers(0, 20), st.tuples(st.integers(0, 9), times), max_size=20)
change_rows = st.dictionaries(st.integers(0, 25), st.tuples(st.integers(10, 19), times), max_size=15)


def _in_window(t):
    lo = dt.datetime.combine(AS_OF - dt.timedelta(days=1), dt.time())
    hi = dt.datetime.combine(AS_OF + dt.timedelta(days=1), dt.time())
    return t is not None and lo < t < hi


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(base=base_rows, changes=change_rows, moving=st.booleans(), change_hours=stamps,
       grain=st.sampled_from(["day", "month"]), corrected=st.booleans())
# every row of 2024-01-02 moves away; the NULL partition empties; pure insert; no change
@example(base={1: (1, 30), 2: (2, 30), 3: (3, 100)}, changes={1: (11, None), 2: (12, None)}, moving=True,
         change_hours=9 * 24, grain="day", corrected=False)
@example(base={1: (1, None), 2: (2, 5)}, changes={1: (11, None)}, moving=True, change_hours=9 * 24 + 3,
         grain="month", corrected=False)
@example(base={1: (1, 5)}, changes={7: (17, 9 * 24)}, moving=False, change_hours=None, grain="day", corrected=False)
@example(base={1: (1, 5), 2: (2, 5)}, changes={1: (11, 200), 2: (12, None)}, moving=False, change_hours=9 * 24, grain="day",
         corrected=True)
@example(base={1: (1, 5)}, changes={}, moving=True, change_hours=9 * 24, grain="day", corrected=False)
@example(base={1: (1, 9 * 24 + 20), 2: (2, 9 * 24 + 20)}, changes={1: (11, None)}, moving=True,
         change_hours=9 * 24 + 2, grain="day", corrected=False)
def test_update_matches_model(spark, tmp_path_factory, base, changes, moving, change_hours, grain, corrected):
    root = str(tmp_path_factory.mktemp("lake"))
    base_data = [(k, v, _stamp(t), _stamp(t)) for k, (v, t) in base.items()]
    # source after the edits: changed keys get a new value and a change stamp (maybe in window)
    source = {k: (k, v, _stamp(t), _stamp(t)) for k, (v, t) in base.items()}
    for k, (v, t) in changes.items():
        created = source[k][2] if k in source and not corrected else _stamp(t)
        source[k] = (k, v, created, _stamp(change_hours if change_hours is not None else t))
    spec = TableSpec("t", ("k",), "created_at", "last_updated_at",
                     partition_column="last_updated_at" if moving else None, grain=grain)
    ctx = EngineContext(spark, FrameSource({"t": spark.createDataFrame(base_data, SCHEMA)}), root, {"t": spec})
    if base_data:
        refresh_table(ctx, "t")
    ctx.source = FrameSource({"t": spark.createDataFrame(list(source.values()), SCHEMA)})
    update_table(ctx, "t", AS_OF, 1)

    window = {k: r for k, r in source.items() if _in_window(r[3])}
    # newest wins: a change older than the lake's row for its key is ignored
    lake_stamp = {r[0]: r[3] for r in base_data}
    window = {k: r for k, r in window.items()
              if not (k in lake_stamp and lake_stamp[k] is not None and r[3] is not None and lake_stamp[k] > r[3])}
    expected = [r for r in base_data if r[0] not in window] + list(window.values())
    pcol = 3 if moving else 2
    want = sorted((r[0], r[1], r[pcol].date() if r[pcol] else None) for r in expected)
    path = f"{root}/t"
    if not lake_exists(spark, path):
        assert want == []
        return
    got = sorted((r.k, r.v, r.partition_date) for r in lake_scan(spark, path).collect())
    assert got == want
    # every partition directory holds rows (emptied ones were removed)
    depth = len(spec.partition_cols)
    for here, dirs, files in os.walk(path):
        rel = os.path.relpath(here, path)
        parts = [] if rel == "." else rel.split(os.sep)
        if parts and not parts[0].startswith("year="):
            continue
        if len(parts) == depth:
            assert any(f.endswith(".parquet") for f in files), rel
        elif parts:
            assert dirs, rel  # no empty intermediate folder
