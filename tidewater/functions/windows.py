"""The change window: rows whose time column lies strictly inside ``as_of ± days``."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(value: _dt.date | _dt.datetime | str | None) -> _dt.date:
    """Normalise an ``as_of`` argument; ``None`` means today's date, fixed once per job."""
    if value is None:
        return _dt.date.today()
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


def window_bounds(as_of=None, days: int = 1) -> tuple[_dt.date, _dt.date]:
    if days < 0:
        raise ValueError("days must be >= 0")
    d = as_date(as_of)
    delta = _dt.timedelta(days=days)
    return d - delta, d + delta


def change_window_condition(column: str, as_of=None, days: int = 1) -> Column:
    """``column > as_of - days AND column < as_of + days`` (both ends exclusive).

    Bounds are DATE literals: against a timestamp column Spark widens the literal, not
    the column, so the comparison is pushed to Parquet row groups and to JDBC sources.
    A NULL time is outside the window.
    """
    lo, hi = window_bounds(as_of, days)
    c = F.col(column)
    return (c > F.lit(lo)) & (c < F.lit(hi))


def window_partition_dates(as_of=None, days: int = 1) -> list[_dt.date]:
    """Calendar dates a window can touch: from ``as_of - days`` to ``as_of + days - 1``."""
    lo, hi = window_bounds(as_of, days)
    return [lo + _dt.timedelta(days=i) for i in range((hi - lo).days)]
