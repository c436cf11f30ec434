"""Column rules the source database enforces with triggers and defaults, as expressions."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HIT = "__tw_changed"


def typed_literal(value, data_type: T.DataType) -> Column:
    """A literal of ``data_type``. Datetimes headed for TIMESTAMP_NTZ are parsed from text so
    no session or process time zone is applied on the way."""
    if isinstance(value, SqlDefault):
        return F.expr(str(value)).cast(data_type)
    if isinstance(value, Column):
        return value.cast(data_type)
    if isinstance(value, _dt.datetime) and isinstance(data_type, T.TimestampNTZType):
        return F.lit(value.replace(tzinfo=None).isoformat(sep=" ")).cast(data_type)
    return F.lit(value).cast(data_type)


def change_stamp(df: DataFrame, changed_keys: DataFrame, keys: Sequence[str],
                 stamp_column: str, at) -> DataFrame:
    """Set ``stamp_column = at`` on the rows whose key is in ``changed_keys``.

    Same effect as an ``ON UPDATE`` trigger stamping ``last_updated_at``. The key set is
    de-duplicated (partial aggregation) before the join so it never multiplies rows.
    """
    keys = list(keys)
    target_type = df.schema[stamp_column].dataType
    marks = changed_keys.select(*keys).distinct().withColumn(_HIT, F.lit(True))
    joined = df.join(marks, keys, "left")
    stamped = (F.when(F.col(_HIT), typed_literal(at, target_type))
               .otherwise(F.col(stamp_column)).alias(stamp_column))
    return joined.select(*[stamped if c == stamp_column else F.col(c) for c in df.columns])


def column_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill NULLs with defaults (``DEFAULT TRUE``, ``0.00``, ``'OPEN'``, ``now()``, uuid).

    A value may be a literal, a Column such as ``F.current_timestamp()``, or a
    ``SqlDefault("uuid()")``. The result keeps the column's type.
    """
    out = []
    for field in df.schema.fields:
        c = field.name
        if c in defaults:
            out.append(F.coalesce(F.col(c), typed_literal(defaults[c], field.dataType)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


class SqlDefault(str):
    """A default given as SQL expression text (``now()``, ``uuid()``), built when used."""


# Column defaults of the financial source schema (DEFAULT clauses of its DDL).
REFERENCE_DEFAULTS: dict[str, dict[str, object]] = {
    "customers": {"is_active": True, "created_at": SqlDefault("now()"), "last_updated_at": SqlDefault("now()")},
    "accounts": {"balance": 0.00, "status": "OPEN", "created_at": SqlDefault("now()"),
                 "last_updated_at": SqlDefault("now()")},
    "transactions": {"transaction_id": SqlDefault("uuid()"), "transaction_time": SqlDefault("now()"),
                     "ingestion_time": SqlDefault("now()"), "created_at": SqlDefault("now()")},
}
