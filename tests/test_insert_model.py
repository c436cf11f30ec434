"""Property test: a sequence of insert windows against a brute-force model.

Without dedupe the lake holds every window's rows once per window that contained them
(bag semantics); with dedupe it holds each key whose created time fell in any window once.
"""

import datetime as dt

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st

from tidewater.plans.context import EngineContext
from tidewater.plans.jobs import insert_table
from tidewater.plans.specs import TableSpec
from tidewater.sources.files import FrameSource
from tidewater.sources.lake import lake_exists, lake_scan

SCHEMA = "k long, created_at timestamp_ntz"
DAY0 = dt.datetime(2024, 1, 1)
times = st.one_of(st.none(), st.integers(min_value=0, max_value=10 * 24 * 60))  # minutes
sources = st.dictionaries(st.integers(0, 60), times, max_size=40)
windows = st.lists(st.integers(min_value=1, max_value=9), min_size=1, max_size=4)


def _in_window(t, as_of, days=1):
    lo = dt.datetime.combine(as_of - dt.timedelta(days=days), dt.time())
    hi = dt.datetime.combine(as_of + dt.timedelta(days=days), dt.time())
    return t is not None and lo < t < hi


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(source=sources, days=windows, dedupe=st.booleans(), grain=st.sampled_from(["day", "month"]))
# overlapping consecutive windows, the same window twice, a NULL time, a month boundary
@example(source={1: 2 * 24 * 60 + 30, 2: 3 * 24 * 60 + 5, 3: None}, days=[3, 4], dedupe=True, grain="day")
@example(source={1: 4 * 24 * 60, 2: 4 * 24 * 60 + 1}, days=[5, 5], dedupe=True, grain="month")
@example(source={1: 4 * 24 * 60 + 1}, days=[5, 5], dedupe=False, grain="day")
def test_insert_matches_model(spark, tmp_path_factory, source, days, dedupe, grain):
    root = str(tmp_path_factory.mktemp("lake"))
    data = [(k, None if m is None else DAY0 + dt.timedelta(minutes=m)) for k, m in source.items()]
    spec = TableSpec("t", ("k",), "created_at", grain=grain)
    ctx = EngineContext(spark, FrameSource({"t": spark.createDataFrame(data, SCHEMA)}), root, {"t": spec})
    expected = []
    for d in days:
        as_of = dt.date(2024, 1, d)
        insert_table(ctx, "t", as_of, 1, dedupe_on_key=dedupe)
        expected += [k for k, t in data if _in_window(t, as_of)]
    if dedupe:
        expected = sorted(set(expected))
    path = f"{root}/t"
    got = sorted(r.k for r in lake_scan(spark, path).collect()) if lake_exists(spark, path) else []
    assert got == sorted(expected)
