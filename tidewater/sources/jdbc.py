"""Relational source over JDBC (``spark.read.jdbc``).

Filters applied to the returned DataFrame (the change window) are compiled by Spark's
JDBC dialect into the remote ``WHERE`` clause, so no dialect-specific SQL is written here.
For large tables give a ``JdbcPartitioning`` so the read runs as ``num_partitions``
parallel range queries instead of a single task.
"""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("tidewater")


@dataclass(frozen=True)
class JdbcPartitioning:
    """Parallel read by ranges of a numeric, date or timestamp column. Leave the bounds as
    ``None`` to have them taken from the source (``min``/``max`` computed remotely)."""

    column: str
    lower_bound: int | str | None = None
    upper_bound: int | str | None = None
    num_partitions: int = 64
    # Equal-width ranges of a skewed column give a few tasks most rows. A frame that has the column
    # with about the same distribution (the lake's copy of the table) gives ranges of equal weight.
    like: DataFrame | None = None

    @property
    def resolved(self) -> bool:
        return self.lower_bound is not None and self.upper_bound is not None

    def options(self) -> dict[str, str]:
        if not self.resolved:
            raise ValueError("bounds not resolved; use JdbcSource.read_options")
        return {"partitionColumn": self.column, "lowerBound": str(self.lower_bound),
                "upperBound": str(self.upper_bound), "numPartitions": str(self.num_partitions)}


def split_points(df: DataFrame, column: str, parts: int, accuracy: int = 100) -> list:
    """Values that cut the column into ``parts`` ranges of about equal weight, ascending and distinct
    (a value that fills several ranges is one point). From a quantile sketch: one aggregate, whose
    result does not grow with ``df``; its rank error is a 1 / (parts * accuracy) of the rows."""
    if parts < 2:
        return []
    row = df.agg(F.percentile_approx(F.col(column), [i / parts for i in range(1, parts)], parts * accuracy).alias("p")).first()
    return sorted(set(row["p"] or []))


def _literal(value) -> str:
    if isinstance(value, (dt.datetime, dt.date)):
        return f"{'TIMESTAMP' if isinstance(value, dt.datetime) else 'DATE'} '{value}'"
    if isinstance(value, (bool, str)):
        raise ValueError("ranges need a numeric, date or timestamp column")
    return str(value)


def range_predicates(column: str, points: Sequence) -> list[str]:
    """SQL predicates of the ranges between the points: every row is in exactly one, NULLs in the first."""
    if not points:
        return ["1 = 1"]
    at = [_literal(p) for p in points]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(at, at[1:])]
    return [f"{column} < {at[0]} OR {column} IS NULL", *middle, f"{column} >= {at[-1]}"]


@dataclass
class JdbcSource:
    spark: SparkSession
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    schema: str | None = None
    partitioning: Mapping[str, JdbcPartitioning] = field(default_factory=dict)
    fetch_size: int = 10_000
    prefer_timestamp_ntz: bool = True

    def _reader(self):
        r = self.spark.read.format("jdbc").option("url", self.url)
        for k, v in self.properties.items():
            r = r.option(k, v)
        r = r.option("fetchsize", str(self.fetch_size))
        if self.prefer_timestamp_ntz:
            r = r.option("preferTimestampNTZ", "true")
        return r

    def qualified(self, name: str) -> str:
        return f"{self.schema}.{name}" if self.schema else name

    def bounds(self, name: str, column: str) -> tuple:
        """``(min, max)`` of a column, computed by the source: the aggregate is pushed into
        the remote query, so only one row travels."""
        row = (self._reader().option("dbtable", self.qualified(name)).option("pushDownAggregate", "true")
               .load().agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first())
        return row["lo"], row["hi"]

    def read_options(self, name: str) -> dict[str, str]:
        opts = {"dbtable": self.qualified(name)}
        part = self.partitioning.get(name)
        if part is not None:
            if not part.resolved:
                lo, hi = self.bounds(name, part.column)
                if lo is None:  # empty table: a single plain read
                    return opts
                part = JdbcPartitioning(part.column, lo, hi, part.num_partitions)
            opts.update(part.options())
        return opts

    def _load(self, reader, what: str) -> DataFrame:
        # load() connects to resolve the schema, so connection and permission errors
        # surface here: log which relation failed, then re-raise.
        try:
            return reader.load()
        except Exception:
            log.exception("reading %s from %s failed", what, self.url.split("?", 1)[0])
            raise

    def table(self, name: str) -> DataFrame:
        """Whole table (jdbc_scan); later filters are pushed into the remote query."""
        part = self.partitioning.get(name)
        if part is not None and part.like is not None:
            points = split_points(part.like, part.column, part.num_partitions)
            props = {**self.properties, "fetchsize": str(self.fetch_size), **({"preferTimestampNTZ": "true"} if self.prefer_timestamp_ntz else {})}
            return self.spark.read.jdbc(self.url, self.qualified(name), predicates=range_predicates(part.column, points), properties=props)
        return self._load(self._reader().options(**self.read_options(name)), self.qualified(name))

    def query(self, sql: str, alias: str = "sql_table",
              predicates: Sequence[str] | None = None) -> DataFrame:
        """A query run by the source (jdbc_query_scan), as an aliased subquery.
        ``predicates`` splits it into one remote query per predicate, read in parallel."""
        dbtable = f"({sql}) AS {alias}"
        if predicates:
            props = {**self.properties, "fetchsize": str(self.fetch_size)}
            if self.prefer_timestamp_ntz:
                props["preferTimestampNTZ"] = "true"
            return self.spark.read.jdbc(self.url, dbtable, predicates=list(predicates), properties=props)
        return self._load(self._reader().option("dbtable", dbtable), alias)

    def list_tables(self) -> list[str]:
        """Base-table names from the standard ``information_schema`` (small, collected)."""
        where = "WHERE table_type = 'BASE TABLE'" + (f" AND table_schema = '{self.schema}'" if self.schema else "")
        frame = self.query(f"SELECT table_name FROM information_schema.tables {where}", alias="table_name_list")
        return sorted(r["table_name"] for r in frame.select("table_name").collect())
